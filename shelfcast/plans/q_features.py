"""Queries: feature family."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.operators import features as FE
from shelfcast.plans import oracle_features as O
from shelfcast.plans import tables as TB
from shelfcast.plans.catalog import register
from shelfcast.plans.sqlbase import with_ctes
from shelfcast.session import cut_lineage


def features_v2_df(spark, sf_dir, horizon=1):
    return FE.features_v2(TB.retail(spark, sf_dir), TB.snapshot(spark, sf_dir), horizon=horizon, include_created_at=False)


def features_table(spark, sf_dir, horizon=1, columns=None):
    """The v2 features (or the ``columns`` a report reads) materialised once in the
    shared checkpoint folder, for reports that run several aggregations over
    them: each branch then re-reads the table instead of recomputing the windows."""
    f = features_v2_df(spark, sf_dir, horizon)
    return cut_lineage(f.select(*columns) if columns else f)


@register("features_v2", O.features_v2_sql(1))
def q_features_v2(spark, sf_dir):
    return features_v2_df(spark, sf_dir, 1)


@register("features_v2_h7", O.features_v2_sql(7))
def q_features_v2_h7(spark, sf_dir):
    return features_v2_df(spark, sf_dir, 7)


@register("features_v1", O.features_v1_sql(1))
def q_features_v1(spark, sf_dir):
    return FE.features_v1(TB.retail(spark, sf_dir), include_created_at=False)


@register("feature_summary", O.feature_summary_sql())
def q_feature_summary(spark, sf_dir):
    return FE.feature_summary(features_v2_df(spark, sf_dir, 1))


_KEYS = ["as_of_date", "store_id", "product_id"]


@register("sales_lags", f"""WITH ff AS ({O.features_v2_sql(1)})
SELECT as_of_date, store_id, product_id, sales_lag_1, sales_lag_7, sales_lag_14, sales_lag_28,
       demand_forecast_lag1 FROM ff""")
def q_sales_lags(spark, sf_dir):
    return features_v2_df(spark, sf_dir).select(*_KEYS, "sales_lag_1", "sales_lag_7", "sales_lag_14",
                                                "sales_lag_28", "demand_forecast_lag1")


@register("rolling_means", f"""WITH ff AS ({O.features_v2_sql(1)})
SELECT as_of_date, store_id, product_id, sales_roll_mean_7, sales_roll_mean_14, sales_roll_mean_28 FROM ff""")
def q_rolling_means(spark, sf_dir):
    return features_v2_df(spark, sf_dir).select(*_KEYS, "sales_roll_mean_7", "sales_roll_mean_14",
                                                "sales_roll_mean_28")


@register("rolling_std", f"""WITH ff AS ({O.features_v2_sql(1)})
SELECT as_of_date, store_id, product_id, sales_roll_std_7 FROM ff""")
def q_rolling_std(spark, sf_dir):
    return features_v2_df(spark, sf_dir).select(*_KEYS, "sales_roll_std_7")


@register("ewm_28", f"""WITH ff AS ({O.features_v2_sql(1)})
SELECT as_of_date, store_id, product_id, sales_ewm_28 FROM ff""")
def q_ewm_28(spark, sf_dir):
    return features_v2_df(spark, sf_dir).select(*_KEYS, "sales_ewm_28")


@register("label_horizon", f"""WITH ff AS ({O.features_v2_sql(7)})
SELECT as_of_date, store_id, product_id, y, y_pred_baseline FROM ff""")
def q_label_horizon(spark, sf_dir):
    return features_v2_df(spark, sf_dir, 7).select(*_KEYS, "y", "y_pred_baseline")


@register("baseline_prediction", f"""WITH ff AS ({O.features_v2_sql(1)})
SELECT as_of_date, store_id, product_id, y_pred_baseline FROM ff""")
def q_baseline(spark, sf_dir):
    return features_v2_df(spark, sf_dir).select(*_KEYS, "y_pred_baseline")


@register("lead_time_join", f"""WITH ff AS ({O.features_v2_sql(1, partial=True)})
SELECT as_of_date, store_id, product_id, lead_time_days, lead_time_demand FROM ff""")
def q_lead_time_join(spark, sf_dir):
    """J01/J02 against a snapshot that misses a series, so that the median fill has something to fill."""
    return FE.features_v2(TB.retail(spark, sf_dir), TB.partial_snapshot(spark, sf_dir), include_created_at=False) \
        .select(*_KEYS, "lead_time_days", "lead_time_demand")


@register("sample_weights", f"""WITH ff AS ({O.features_v2_sql(1)})
SELECT store_id, MIN(sample_weight) AS sample_weight, COUNT(*) AS n_rows FROM ff GROUP BY store_id""")
def q_sample_weights(spark, sf_dir):
    f = features_v2_df(spark, sf_dir)
    return f.groupBy("store_id").agg(F.min("sample_weight").alias("sample_weight"),
                                     F.count(F.lit(1)).alias("n_rows"))


@register("dedup", """WITH raw AS (
  SELECT CAST(l_shipdate AS DATE) AS date, 'S00' || CAST(l_suppkey % 5 + 1 AS VARCHAR) AS store_id,
         'P' || lpad(CAST(l_partkey % 20 + 1 AS VARCHAR), 4, '0') AS product_id,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS units_sold
  FROM lineitem)
SELECT date, store_id, product_id, units_sold FROM (
  SELECT *, row_number() OVER (PARTITION BY store_id, product_id, date
                               ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, units_sold) AS rk
  FROM raw) t WHERE rk = 1""")
def q_dedup(spark, sf_dir):
    """P02 on raw line rows: the first line per (date, store, product) in line order."""
    from shelfcast.sources.testdata import read_table
    li = read_table(spark, sf_dir, "lineitem")
    raw = li.select(F.col("l_shipdate").cast("date").alias("date"),
                    F.concat(F.lit("S00"), (F.col("l_suppkey") % 5 + 1).cast("string")).alias("store_id"),
                    F.concat(F.lit("P"), F.lpad((F.col("l_partkey") % 20 + 1).cast("string"), 4, "0"))
                     .alias("product_id"),
                    F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             F.col("l_quantity").cast("long").alias("q")).alias("ingest"),
                    F.col("l_quantity").cast("long").alias("units_sold"))
    return FE.dedup_keep_first(raw, order_col="ingest", method="aggregate").select(
        "date", "store_id", "product_id", "units_sold")


@register("clip_negatives", """WITH d AS (SELECT CAST(l_shipdate AS DATE) AS date, l_orderkey, l_linenumber,
  l_partkey, l_suppkey, CAST(l_quantity - 25 AS BIGINT) AS units_sold, CAST(l_quantity - 10 AS BIGINT) AS inventory_level
  FROM lineitem)
SELECT COUNT(*) AS n_rows,
       CAST(SUM(CASE WHEN units_sold < 0 THEN 1 ELSE 0 END) AS BIGINT) AS neg_units,
       CAST(SUM(CASE WHEN units_sold < 0 THEN 0 ELSE units_sold END) AS BIGINT) AS sum_units,
       CAST(SUM(CASE WHEN inventory_level < 0 THEN 0 ELSE inventory_level END) AS BIGINT) AS sum_level,
       MIN(CASE WHEN units_sold < 0 THEN 0 ELSE units_sold END) AS min_units
FROM d""")
def q_clip_negatives(spark, sf_dir):
    """P03 on shifted line quantities (so negatives occur): clipped totals."""
    from shelfcast.sources.testdata import read_table
    li = read_table(spark, sf_dir, "lineitem")
    d = li.select((F.col("l_quantity") - 25).cast("long").alias("units_sold"),
                  (F.col("l_quantity") - 10).cast("long").alias("inventory_level"))
    c = FE.clip_negatives(d.select("*", (F.col("units_sold") < 0).alias("_neg")))
    return c.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.sum(F.col("_neg").cast("int")).cast("long").alias("neg_units"),
                 F.sum("units_sold").alias("sum_units"), F.sum("inventory_level").alias("sum_level"),
                 F.min("units_sold").alias("min_units"))


@register("retail_daily", with_ctes("retail_daily") + "SELECT * FROM retail_daily")
def q_retail_daily(spark, sf_dir):
    """The daily store x product table (derived from the line table)."""
    return TB.retail(spark, sf_dir)


@register("inventory_snapshot", with_ctes("inventory_snapshot") + "SELECT * FROM inventory_snapshot")
def q_inventory_snapshot(spark, sf_dir):
    """The current-state snapshot (one row per store x product)."""
    return TB.snapshot(spark, sf_dir)


@register("ewm_28_adjusted", with_ctes("retail_daily") + """SELECT date, store_id, product_id,
  SUM(units_sold * pow(29e0 / 27e0, rn)) OVER s / SUM(pow(29e0 / 27e0, rn)) OVER s AS sales_ewm_28_adjusted
FROM (SELECT *, row_number() OVER (PARTITION BY store_id, product_id ORDER BY date) AS rn FROM retail_daily) t
WINDOW s AS (PARTITION BY store_id, product_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_ewm_28_adjusted(spark, sf_dir):
    """EWM(span 28, adjust=True) of daily units per series, current row included."""
    from shelfcast.functions.ewm import ewm_adjust_true
    r = TB.retail(spark, sf_dir).select("date", "store_id", "product_id", "units_sold")
    return ewm_adjust_true(r, "units_sold", ["store_id", "product_id"], "date",
                           out="sales_ewm_28_adjusted").drop("units_sold")

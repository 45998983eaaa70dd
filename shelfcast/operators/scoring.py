"""Online-style scoring features for all series at once.

The source computes these for one (store, product) per request from its
last 30 daily rows.  Here W11 keeps the last ``n`` rows of every series
(``row_number`` with a WindowGroupLimit before the shuffle, so at most n
rows per series travel), and one group-by per series turns them into the
feature row with conditional aggregates over the row position — bounded by
n per group by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast import config as C
from shelfcast.functions import scalar as S

KEYS = ["store_id", "product_id"]


def _at(pos_from_end: int, col: str = "units_sold"):
    """Value ``pos_from_end`` rows before the end (1 = last row)."""
    return F.max(F.when(F.col("pos") == F.col("n") - (pos_from_end - 1), F.col(col)))


def scoring_features(history: DataFrame, snapshot: DataFrame, n: int = 30, span: int = 28,
                     discount_unit: str = "fraction") -> DataFrame:
    """One feature row per series from its last ``n`` rows and its snapshot row.

    ``discount_unit`` says what the history holds; the features hold fractions.
    """
    w = Window.partitionBy(*KEYS).orderBy(F.col("date").desc())
    last = history.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= n)
    last = last.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*KEYS))) \
               .withColumn("pos", F.col("n") - F.col("_rk") + 1)
    q = 1.0 - 2.0 / (span + 1.0)
    x = F.col("units_sold").cast("double")
    wgt = F.pow(F.lit(q), (F.col("n") - F.col("pos")).cast("double"))
    tail = lambda k: F.col("pos") > F.col("n") - k
    g = last.groupBy(*KEYS).agg(
        F.first("n").alias("n_rows"),
        _at(1).cast("double").alias("lag1"), _at(7).cast("double").alias("lag7"),
        _at(14).cast("double").alias("lag14"), _at(28).cast("double").alias("lag28"),
        F.avg(F.when(tail(7), x)).alias("sales_roll_mean_7"),
        F.avg(F.when(tail(14), x)).alias("sales_roll_mean_14"),
        F.avg(F.when(tail(28), x)).alias("sales_roll_mean_28"),
        F.stddev_samp(F.when(tail(7), x)).alias("_std7"),
        (F.sum(F.when(x.isNotNull(), x * wgt)) / F.sum(F.when(x.isNotNull(), wgt))).alias("sales_ewm_28"),
        _at(1, "price").alias("price"), _at(1, "competitor_pricing").alias("competitor"),
        _at(1, "discount").cast("double").alias("discount"),
        _at(1, "holiday_promotion").alias("holiday_promotion"),
        _at(1, "demand_forecast").alias("_dfl"), _at(1, "seasonality").alias("seasonality"))
    enough = lambda k: F.col("n_rows") >= k
    g = g.withColumns({
        "sales_lag_1": F.col("lag1"),
        "sales_lag_7": F.when(enough(7), F.col("lag7")).otherwise(F.col("lag1")),
        "sales_lag_14": F.when(enough(14), F.col("lag14")).otherwise(F.col("lag1")),
        "sales_lag_28": F.when(enough(28), F.col("lag28")).otherwise(F.col("lag1")),
        "sales_roll_std_7": F.when(enough(7), F.col("_std7")).otherwise(F.lit(0.0)),
    })
    snap = snapshot.select(*KEYS, F.col("current_stock").alias("inventory_level"), "lead_time_days",
                           "category", "region")
    j = g.join(snap, KEYS, "inner")
    d = F.col("discount") if discount_unit == "fraction" else F.col("discount") / F.lit(100.0)
    return j.select(
        *KEYS,
        "sales_lag_1", "sales_lag_7", "sales_lag_14", "sales_lag_28",
        "sales_roll_mean_7", "sales_roll_mean_14", "sales_roll_mean_28", "sales_roll_std_7", "sales_ewm_28",
        F.coalesce("_dfl", "sales_lag_1").alias("demand_forecast_lag1"),
        F.when(F.col("competitor") > 0, S.round_half_even(F.col("price") / F.col("competitor"), 4))
         .otherwise(F.lit(1.0)).alias("price_vs_competitor"),
        S.round_half_even(F.col("price") * (F.lit(1.0) - d), 2).alias("effective_price"),
        "holiday_promotion", d.alias("discount"),
        S.round_half_even(d * F.col("holiday_promotion"), 4).alias("discount_x_holiday"),
        "inventory_level", (F.col("inventory_level") <= 0).cast("int").alias("stockout_flag"),
        S.round_half_even(F.col("sales_roll_mean_7") * F.col("lead_time_days"), 2).alias("lead_time_demand"),
        "lead_time_days", (F.col("inventory_level") < 50).cast("int").alias("reorder_event"),
        "category", "region", "seasonality",
        F.col("sales_lag_1").alias("y_pred_baseline"),
    ).select("*",
             F.coalesce(F.try_element_at(_map(C.SCORER_CATEGORY_CODES), F.col("category")),
                        F.lit(C.SCORER_DEFAULTS["category_enc"])).alias("category_enc"),
             F.coalesce(F.try_element_at(_map(C.SCORER_REGION_CODES), F.col("region")),
                        F.lit(C.SCORER_DEFAULTS["region_enc"])).alias("region_enc"),
             F.coalesce(F.try_element_at(_map(C.SCORER_SEASON_CODES | C.SCORER_SEASON_ALIASES), F.col("seasonality")),
                        F.lit(C.SCORER_DEFAULTS["seasonality_enc"])).alias("seasonality_enc"),
             ).drop("category", "region", "seasonality")


def _map(m: dict):
    pairs = []
    for k, v in m.items():
        pairs += [F.lit(k), F.lit(int(v))]
    return F.create_map(*pairs)


def cold_start_features(snapshot: DataFrame) -> DataFrame:
    """Default features for series without history, from the snapshot alone."""
    avg = F.col("total_units_sold").cast("double") / F.lit(30.0)
    inv = F.coalesce(F.col("current_stock"), F.lit(0)).cast("long")
    return snapshot.select(
        *KEYS,
        *[avg.alias(c) for c in ("sales_lag_1", "sales_lag_7", "sales_lag_14", "sales_lag_28",
                                 "sales_roll_mean_7", "sales_roll_mean_14", "sales_roll_mean_28",
                                 "sales_ewm_28", "demand_forecast_lag1", "y_pred_baseline")],
        (avg * F.lit(0.1)).alias("sales_roll_std_7"),
        inv.alias("inventory_level"), (inv == 0).cast("int").alias("stockout_flag"),
        F.coalesce(F.col("lead_time_days"), F.lit(7)).cast("long").alias("lead_time_days"),
        (inv.cast("double") * F.lit(0.2)).alias("lead_time_demand"),
        F.lit(0).alias("reorder_event"), F.lit(0).alias("category_enc"), F.lit(0).alias("region_enc"),
        F.lit(0).alias("seasonality_enc"), F.lit(10.0).alias("effective_price"),
        F.lit(1.0).alias("price_vs_competitor"), F.lit(0.0).alias("discount"),
        F.lit(0).alias("holiday_promotion"), F.lit(0.0).alias("discount_x_holiday"))

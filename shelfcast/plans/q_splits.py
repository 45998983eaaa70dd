"""Queries: splits, folds, scaling, series codes, metrics of the baseline."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast import config as C
from shelfcast.operators import bias as B
from shelfcast.operators import splits as SP
from shelfcast.plans import tables as TB
from shelfcast.plans.catalog import register
from shelfcast.plans.q_features import features_table, features_v2_df
from shelfcast.plans.q_quality import ff
from shelfcast.plans.sqlbase import with_ctes
from shelfcast.session import cut_lineage

CUTS = """SELECT max(CASE WHEN rk = CAST(floor(n * 0.8e0) AS BIGINT) THEN d END) AS train_end,
  max(CASE WHEN rk = CAST(floor(n * (0.8e0 + 0.1e0)) AS BIGINT) THEN d END) AS val_end
FROM (SELECT d, row_number() OVER (ORDER BY d) AS rk, COUNT(*) OVER () AS n
      FROM (SELECT DISTINCT as_of_date AS d FROM ff) x) y"""
SPLIT = """SELECT ff.*, CASE WHEN as_of_date <= train_end THEN 'train' WHEN as_of_date <= val_end THEN 'val'
  ELSE 'test' END AS split FROM ff, cuts"""


def ssql(body: str, extra=None) -> str:
    return ff(body, [("cuts", CUTS), ("sp", SPLIT)] + (extra or []))


def split_df(spark, sf_dir):
    return SP.chronological_split(features_v2_df(spark, sf_dir))


def split_table(spark, sf_dir, columns=None):
    """Split over the materialised features (or the ``columns`` that are read), for
    queries with several branches (fit statistics and transform)."""
    return SP.chronological_split(features_table(spark, sf_dir, columns=columns))


@register("chronological_split", ssql("SELECT as_of_date, store_id, product_id, split FROM sp"))
def q_chronological_split(spark, sf_dir):
    return split_df(spark, sf_dir).select("as_of_date", "store_id", "product_id", "split")


@register("split_summary", ssql("""SELECT split, rows, end_date, round_even(rows / SUM(rows) OVER () * 100e0, 1) AS pct
FROM (SELECT split, COUNT(*) AS rows, MAX(as_of_date) AS end_date FROM sp GROUP BY split) g"""))
def q_split_summary(spark, sf_dir):
    return SP.split_summary(split_df(spark, sf_dir))


@register("split_checks", ssql("""SELECT * FROM (VALUES ('train_not_empty'), ('val_not_empty'), ('test_not_empty'),
  ('train_before_val'), ('val_before_test'), ('full_coverage')) c("check"), LATERAL (SELECT CASE "check"
  WHEN 'train_not_empty' THEN count_if(split = 'train') > 0
  WHEN 'val_not_empty' THEN count_if(split = 'val') > 0
  WHEN 'test_not_empty' THEN count_if(split = 'test') > 0
  WHEN 'train_before_val' THEN COALESCE(MAX(CASE WHEN split = 'train' THEN as_of_date END)
                                        < MIN(CASE WHEN split = 'val' THEN as_of_date END), true)
  WHEN 'val_before_test' THEN COALESCE(MAX(CASE WHEN split = 'val' THEN as_of_date END)
                                       < MIN(CASE WHEN split = 'test' THEN as_of_date END), true)
  ELSE count_if(split IN ('train', 'val', 'test')) = COUNT(*) END AS passed FROM sp) r"""))
def q_split_checks(spark, sf_dir):
    return SP.split_checks(split_df(spark, sf_dir))


FOLDS = """SELECT CAST(fold_number AS INTEGER) AS fold_number, min_date AS train_start, train_end, val_start,
  LEAST(val_start + INTERVAL 60 DAY, max_date)::DATE AS val_end
FROM (SELECT i AS fold_number, min_date, max_date, (min_date + CAST(step * i AS INTEGER))::DATE AS train_end,
             (min_date + CAST(step * i + 14 AS INTEGER))::DATE AS val_start
      FROM (SELECT MIN(as_of_date) AS min_date, MAX(as_of_date) AS max_date,
                   CAST(floor((date_diff('day', MIN(as_of_date), MAX(as_of_date)) - 74) / 5e0) AS INTEGER) AS step
            FROM sp WHERE split = 'train') b, range(1, 6) r(i)) f
WHERE fold_number < COALESCE((SELECT MIN(i) FROM (SELECT i, (min_date + CAST(step * i + 14 AS INTEGER))::DATE AS vs, max_date
  FROM (SELECT MIN(as_of_date) AS min_date, MAX(as_of_date) AS max_date,
               CAST(floor((date_diff('day', MIN(as_of_date), MAX(as_of_date)) - 74) / 5e0) AS INTEGER) AS step
        FROM sp WHERE split = 'train') b, range(1, 6) r(i)) z WHERE vs >= max_date), 99)"""


@register("walk_forward_folds", ssql("""SELECT f.fold_number, train_start, train_end, val_start, val_end,
  (SELECT COUNT(*) FROM sp WHERE split = 'train' AND as_of_date <= f.train_end) AS n_train,
  (SELECT COUNT(*) FROM sp WHERE split = 'train' AND as_of_date > f.val_start AND as_of_date <= f.val_end) AS n_val
FROM folds f WHERE n_train > 0 AND n_val > 0""", [("folds", FOLDS)]))
def q_walk_forward_folds(spark, sf_dir):
    train = split_df(spark, sf_dir).filter(F.col("split") == "train")
    return SP.walk_forward_folds(train)


@register("series_encoding", ssql("""SELECT s.series_id, COALESCE(m.series_enc, -1) AS series_enc
FROM (SELECT DISTINCT series_id FROM sp) s LEFT JOIN
     (SELECT series_id, CAST(dense_rank() OVER (ORDER BY series_id) - 1 AS INTEGER) AS series_enc
      FROM (SELECT DISTINCT series_id FROM sp WHERE split = 'train') t) m USING (series_id)"""))
def q_series_encoding(spark, sf_dir):
    sp = split_df(spark, sf_dir)
    # one pass over the pipeline: the distinct series with an in-train flag
    # (one row per series), materialised; codes and the lookup read that
    ids = cut_lineage(sp.groupBy("series_id").agg(
        F.max((F.col("split") == "train").cast("int")).alias("in_train")))
    _mapping, _train, enc = SP.encode_series(ids.filter(F.col("in_train") == 1).select("series_id"),
                                             ids.select("series_id"))
    return enc.select("series_id", F.col("series_enc").cast("int").alias("series_enc"))


# Values are compared at 5 decimals: the engines sum in different orders.
_MU = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS mu_{c}, CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) = 0 THEN 1e0 "
                f"ELSE stddev_pop(CAST({c} AS DOUBLE)) END AS sd_{c}" for c in C.SCALED_COLUMNS)


@register("scaled_features", ssql("SELECT as_of_date, store_id, product_id, split, " + ", ".join(
    f"round((CAST({c} AS DOUBLE) - mu_{c}) / sd_{c}, 5) + 0e0 AS {c}" for c in C.SCALED_COLUMNS) + " FROM sp, st",
    [("st", f"SELECT {_MU} FROM sp WHERE split = 'train'")]))
def q_scaled_features(spark, sf_dir):
    sp = split_table(spark, sf_dir, ["as_of_date", "store_id", "product_id", *C.SCALED_COLUMNS])
    stats = SP.scaler_stats(sp.filter(F.col("split") == "train"))
    return SP.apply_scaler(sp, stats).select("as_of_date", "store_id", "product_id", "split", *[
        (F.round(c, 5) + F.lit(0.0)).alias(c) for c in C.SCALED_COLUMNS])


@register("scaler_stats", ssql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", avg(CAST({c} AS DOUBLE)) AS mean, CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) = 0 "
    f"THEN 1e0 ELSE stddev_pop(CAST({c} AS DOUBLE)) END AS std FROM sp WHERE split = 'train'"
    for c in C.SCALED_COLUMNS)))
def q_scaler_stats(spark, sf_dir):
    return SP.scaler_stats(split_df(spark, sf_dir).filter(F.col("split") == "train"))


@register("series_min_history", ssql("""SELECT series_id, COUNT(*) AS n_rows FROM sp WHERE split = 'train'
GROUP BY series_id HAVING COUNT(*) >= 30"""))
def q_series_min_history(spark, sf_dir):
    return SP.series_min_history(split_df(spark, sf_dir).filter(F.col("split") == "train"))


@register("series_missing_in_test", ssql("""SELECT DISTINCT series_id FROM sp WHERE split = 'train'
  AND series_id NOT IN (SELECT series_id FROM sp WHERE split = 'test')"""))
def q_series_missing_in_test(spark, sf_dir):
    """J09 over the whole split (a store without test rows is in the unit tests)."""
    sp = split_df(spark, sf_dir)
    return SP.series_missing_in_test(sp.filter(F.col("split") == "train"), sp.filter(F.col("split") == "test"))


@register("series_list", ssql("SELECT DISTINCT series_id FROM sp"))
def q_series_list(spark, sf_dir):
    return SP.series_list(split_df(spark, sf_dir))


@register("latest_history", with_ctes("retail_daily") + """SELECT store_id, product_id, date, units_sold, CAST(COUNT(*) OVER (PARTITION BY store_id, product_id) - rk + 1 AS INTEGER)
  AS pos
FROM (SELECT *, row_number() OVER (PARTITION BY store_id, product_id ORDER BY date DESC) AS rk
      FROM retail_daily) t
WHERE rk <= 30""")
def q_latest_history(spark, sf_dir):
    return SP.latest_history(TB.retail(spark, sf_dir)).select("store_id", "product_id", "date", "units_sold", "pos")


def _metrics_sql(where: str, group: str = "") -> str:
    g = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    e = "CAST(y - y_pred_baseline AS DOUBLE)"
    return f"""SELECT {g}round_even(avg(abs({e})), 4) AS mae, round_even(sqrt(avg({e} * {e})), 4) AS rmse,
  round_even(avg(CASE WHEN y > 0 THEN abs({e} / y) END) * 100e0, 4) AS mape,
  round_even(CASE WHEN var_pop(CAST(y AS DOUBLE)) * COUNT(y) > 0
             THEN 1e0 - SUM({e} * {e}) / (var_pop(CAST(y AS DOUBLE)) * COUNT(y)) END, 4) AS r2,
  COUNT(*) AS n FROM sp WHERE {where}{gb}"""


@register("regression_metrics", ssql(_metrics_sql("split = 'test'")))
def q_regression_metrics(spark, sf_dir):
    t = split_df(spark, sf_dir).filter(F.col("split") == "test")
    return B.regression_metrics(t, pred="y_pred_baseline")


@register("series_metrics", ssql(_metrics_sql("split = 'test'", "series_id") + " UNION ALL "
                                 + _metrics_sql("split = 'test'").replace("SELECT ", "SELECT '_all' AS series_id, ", 1)))
def q_series_metrics(spark, sf_dir):
    t = split_df(spark, sf_dir).filter(F.col("split") == "test")
    per = B.regression_metrics(t, pred="y_pred_baseline", group=["series_id"])
    pooled = B.regression_metrics(t, pred="y_pred_baseline").select(F.lit("_all").alias("series_id"), "*")
    return per.unionByName(pooled)


@register("fold_average", ssql("""SELECT avg(mae) AS avg_mae, avg(rmse) AS avg_rmse, avg(r2) AS avg_r2,
  COUNT(*) AS n_folds FROM (""" + """SELECT fold_number, round_even(avg(abs(CAST(y - y_pred_baseline AS DOUBLE))), 4) AS mae,
  round_even(sqrt(avg(CAST(y - y_pred_baseline AS DOUBLE) * CAST(y - y_pred_baseline AS DOUBLE))), 4) AS rmse,
  round_even(CASE WHEN var_pop(CAST(y AS DOUBLE)) * COUNT(y) > 0 THEN 1e0 - SUM(CAST(y - y_pred_baseline AS DOUBLE)
    * CAST(y - y_pred_baseline AS DOUBLE)) / (var_pop(CAST(y AS DOUBLE)) * COUNT(y)) END, 4) AS r2
FROM sp JOIN folds f ON sp.as_of_date > f.val_start AND sp.as_of_date <= f.val_end
WHERE split = 'train' GROUP BY fold_number) pf""", [("folds", FOLDS)]))
def q_fold_average(spark, sf_dir):
    train = split_df(spark, sf_dir).filter(F.col("split") == "train")
    m = SP.fold_membership(train).filter(F.col("role") == "val")
    per_fold = B.regression_metrics(m, pred="y_pred_baseline", group=["fold_number"])
    return SP.fold_average(per_fold)


@register("best_worst_series", ssql("""SELECT * FROM (SELECT series_id, mae, 'best' AS kind FROM m
  ORDER BY mae, series_id LIMIT 3)
UNION ALL SELECT * FROM (SELECT series_id, mae, 'worst' AS kind FROM m ORDER BY mae DESC, series_id LIMIT 3)""",
                                    [("m", "SELECT series_id, avg(abs(CAST(y - y_pred_baseline AS DOUBLE))) AS mae "
                                           "FROM sp WHERE split = 'val' GROUP BY series_id")]))
def q_best_worst_series(spark, sf_dir):
    v = split_df(spark, sf_dir).filter(F.col("split") == "val")
    per = v.groupBy("series_id").agg(F.avg(F.abs((F.col("y") - F.col("y_pred_baseline")).cast("double")))
                                     .alias("mae"))
    return SP.best_worst(per).select("series_id", "mae", "kind")


# Stated apart from the operator's maps: the names the feature pipeline encodes, in code order.
SLICE_NAMES = {
    "category_enc": {0: "Groceries", 1: "Snacks", 2: "Beverages", 3: "Household", 4: "Personal Care", -1: "Unknown"},
    "region_enc": {0: "North", 1: "South", 2: "East", 3: "West", 4: "Central", -1: "Unknown"},
    "seasonality_enc": {0: "Winter", 1: "Spring", 2: "Summer", 3: "Autumn", -1: "Unknown"},
}


def _model_bias_sql() -> str:
    parts = []
    for c, m in SLICE_NAMES.items():
        case = " ".join(f"WHEN {k} THEN '{v}'" for k, v in m.items())
        parts.append(f"SELECT '{c}' AS slice_col, CASE {c} {case} END AS slice_val, y, y_pred_baseline FROM t")
    e = "CAST(y - y_pred_baseline AS DOUBLE)"
    met = (f"round_even(avg(abs({e})), 4) AS mae, round_even(sqrt(avg({e} * {e})), 4) AS rmse, "
           f"round_even(CASE WHEN var_pop(CAST(y AS DOUBLE)) * COUNT(y) > 0 THEN 1e0 - SUM({e} * {e}) / "
           f"(var_pop(CAST(y AS DOUBLE)) * COUNT(y)) END, 4) AS r2, COUNT(*) AS n")
    txt = ("printf('%s=%s: error %s%% above average; give the slice more weight, a model or features of its own.', "
           "slice_col, slice_val, CAST(round_even((mae - overall_mae) / overall_mae * 100e0, 1) AS VARCHAR))")
    return ssql(f"""SELECT slice_col, slice_val, mae, rmse, r2, n, overall_mae,
  COALESCE(CASE WHEN overall_mae > 0 THEN (mae - overall_mae) / overall_mae END > 0.25, false) AS flagged,
  CASE WHEN COALESCE(CASE WHEN overall_mae > 0 THEN (mae - overall_mae) / overall_mae END > 0.25, false)
       THEN round_even((mae - overall_mae) / overall_mae * 100e0, 1) END AS disparity_pct,
  CASE WHEN COALESCE(CASE WHEN overall_mae > 0 THEN (mae - overall_mae) / overall_mae END > 0.25, false)
       THEN {txt} END AS mitigation
FROM (SELECT slice_col, slice_val, {met} FROM ({' UNION ALL '.join(parts)}) l
      WHERE slice_val IS NOT NULL GROUP BY 1, 2) s,
     (SELECT round_even(avg(abs({e})), 4) AS overall_mae FROM t) o
WHERE n >= 10""", [("t", "SELECT * FROM sp WHERE split = 'test'")])


@register("model_slice_bias", _model_bias_sql())
def q_model_slice_bias(spark, sf_dir):
    t = split_df(spark, sf_dir).filter(F.col("split") == "test")
    return B.model_slice_bias(t, pred="y_pred_baseline")

"""Queries: slice bias on the v2 feature table (baseline predictions)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast import config as C
from shelfcast.operators import bias as B
from shelfcast.plans.catalog import register
from shelfcast.plans.q_features import features_table
from shelfcast.plans.q_quality import ff


def perf_df(spark, sf_dir):
    return B.slice_performance(features_table(spark, sf_dir, columns=[*C.BIAS_SLICE_COLUMNS, "y", "y_pred_baseline"]))


def _perf_sql_body() -> str:
    cols = C.BIAS_SLICE_COLUMNS
    pairs = " UNION ALL ".join(
        f"SELECT '{c}' AS slice_col, CAST({c} AS VARCHAR) AS slice_val, ok, ae, ape FROM b" for c in cols)
    return f""", b AS (SELECT *, y IS NOT NULL AND y_pred_baseline IS NOT NULL AS ok,
   CASE WHEN y IS NOT NULL AND y_pred_baseline IS NOT NULL THEN abs(CAST(y - y_pred_baseline AS DOUBLE)) END AS ae,
   CASE WHEN y IS NOT NULL AND y_pred_baseline IS NOT NULL AND y <> 0
        THEN abs(CAST(y - y_pred_baseline AS DOUBLE) / CAST(y AS DOUBLE)) END AS ape FROM ff),
 ov AS (SELECT COUNT(*) AS total_rows, count_if(ok) AS overall_count, avg(ae) AS overall_mae,
               avg(ape) * 100e0 AS overall_mape FROM b),
 g AS (SELECT slice_col, slice_val, COUNT(*) AS sample_count, count_if(ok) AS usable, avg(ae) AS mae,
              avg(ape) * 100e0 AS mape FROM ({pairs}) l WHERE slice_val IS NOT NULL GROUP BY 1, 2),
 perf AS (SELECT slice_col, slice_val, sample_count, sample_count / total_rows AS sample_ratio, mae, mape,
     CASE WHEN overall_mae > 0 THEN mae / overall_mae END AS mae_ratio,
     COALESCE(CASE WHEN overall_mae > 0 THEN mae / overall_mae END > 1.2, true) AS bias_flag,
     overall_mae, overall_mape, overall_count
   FROM g, ov WHERE usable > 0)
"""


def psql(body: str) -> str:
    return ff("").rstrip() + _perf_sql_body() + body


@register("slice_performance", psql("SELECT * FROM perf"))
def q_slice_performance(spark, sf_dir):
    return perf_df(spark, sf_dir)


@register("bias_summary", psql("""SELECT CAST(SUM(n) AS BIGINT) AS total_slices_analyzed,
  CAST(SUM(f) AS BIGINT) AS high_bias_slices, CAST(SUM(l) + count_if(oc < 100) AS BIGINT) AS low_sample_slices
FROM (SELECT slice_col, COUNT(*) AS n, count_if(bias_flag) AS f, count_if(sample_count < 100) AS l,
             first(overall_count) AS oc FROM perf GROUP BY slice_col) t"""))
def q_bias_summary(spark, sf_dir):
    return B.bias_summary(perf_df(spark, sf_dir))


@register("mitigation_plan", psql(""", pc AS (SELECT slice_col, COUNT(*) AS n_slices,
  count_if(sample_count < 100) AS low_sample_slices, count_if(bias_flag) AS high_bias_slices FROM perf GROUP BY slice_col)
SELECT slice_col, slice_val, sample_count, sample_count < 100 AS low_sample, bias_flag AS high_bias,
  1e0 / GREATEST(sample_count / (n_slices + 1), 0.01) AS weight,
  concat_ws(' ', CASE WHEN sample_count < 100 THEN printf('%s has only %d rows: collect or oversample.', slice_val, sample_count) END,
    CASE WHEN bias_flag THEN printf('%s is predicted worse than average (error ratio %s): look for features that explain it.',
      slice_val, CASE WHEN mae_ratio IS NULL THEN 'None' ELSE printf('%.2f', mae_ratio) END) END) AS recommendations,
  low_sample_slices, high_bias_slices,
  CASE WHEN low_sample_slices > 0 AND high_bias_slices > 0 THEN 'high'
       WHEN low_sample_slices > 0 OR high_bias_slices > 0 THEN 'medium' ELSE 'low' END AS priority
FROM perf JOIN pc USING (slice_col)"""))
def q_mitigation_plan(spark, sf_dir):
    """B02 full plan, one row per slice value (weights, flags, sentences as one text, priority)."""
    plan = B.mitigation_plan(perf_df(spark, sf_dir))
    return plan.withColumn("recommendations", F.concat_ws(" ", "recommendations"))


@register("mitigation_priority", psql("""SELECT slice_col, count_if(sample_count < 100) AS low_sample_slices,
  count_if(bias_flag) AS high_bias_slices,
  CASE WHEN count_if(sample_count < 100) > 0 AND count_if(bias_flag) > 0 THEN 'high'
       WHEN count_if(sample_count < 100) > 0 OR count_if(bias_flag) > 0 THEN 'medium' ELSE 'low' END AS priority,
  COUNT(*) AS n_weights
FROM perf GROUP BY slice_col"""))
def q_mitigation_priority(spark, sf_dir):
    p = B.mitigation_plan(perf_df(spark, sf_dir))
    return p.groupBy("slice_col", "low_sample_slices", "high_bias_slices", "priority").agg(
        F.count(F.lit(1)).alias("n_weights"))


@register("mitigation_weights", psql("""SELECT slice_col, slice_val,
  1e0 / GREATEST(sample_count / (COUNT(*) OVER (PARTITION BY slice_col) + 1), 0.01) AS weight FROM perf"""))
def q_mitigation_weights(spark, sf_dir):
    p = B.mitigation_plan(perf_df(spark, sf_dir))
    return p.select("slice_col", "slice_val", "weight")

"""Queries: data quality and anomaly reports on the v2 feature table."""

from __future__ import annotations

from shelfcast import config as C
from shelfcast.operators import quality as Q
from shelfcast.plans import oracle_features as O
from shelfcast.plans.catalog import register
from shelfcast.plans.q_features import features_table, features_v2_df

FEATURE_OUT = [c for c in C.FINAL_COLS if c != "created_at"]
NON_NUMERIC = {"as_of_date", "series_id", "pipeline_version", "store_id", "product_id"}


def ff(body: str, extra: list[tuple[str, str]] | None = None) -> str:
    ctes = "".join(f",\n {n} AS ({q})" for n, q in (extra or []))
    return f"WITH ff AS ({O.features_v2_sql(1)}){ctes}\n{body}"


def _stats_sql() -> str:
    parts = []
    for c in FEATURE_OUT:
        if c in NON_NUMERIC:
            m = s = lo = hi = "CAST(NULL AS DOUBLE)"
        else:
            x = f"CAST({c} AS DOUBLE)"
            m, s, lo, hi = f"avg({x})", f"stddev_samp({x})", f"min({x})", f"max({x})"
        parts.append(f"SELECT '{c}' AS \"column\", {m} AS mean, {s} AS std, {lo} AS min, {hi} AS max, "
                     f"count_if({c} IS NULL) / COUNT(*) AS null_pct FROM ff")
    return ff("\nUNION ALL\n".join(parts))


@register("column_stats", _stats_sql())
def q_column_stats(spark, sf_dir):
    return Q.column_stats(features_v2_df(spark, sf_dir))  # one aggregate: nothing to stage


def _missing_body(th: float = C.MISSING_THRESHOLD) -> str:
    parts = [f"SELECT '{c}' AS \"column\", count_if({c} IS NULL) AS null_count, COUNT(*) AS total_count FROM ff"
             for c in FEATURE_OUT]
    return f"""SELECT *, null_count / total_count AS null_percentage, null_count / total_count > {th} AS is_anomaly,
  CASE WHEN null_count / total_count > {th} THEN (CASE WHEN null_count / total_count > 0.1 THEN 'high'
       ELSE 'medium' END) END AS severity
FROM ({' UNION ALL '.join(parts)}) m"""


def _missing_sql() -> str:
    return ff(_missing_body())


@register("missingness", _missing_sql())
def q_missingness(spark, sf_dir):
    return Q.missingness(features_v2_df(spark, sf_dir))


OUTLIER_COLS = ("y", "inventory_level")


def _outlier_stats(cols=OUTLIER_COLS) -> str:
    st = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS mu{i}, stddev_pop(CAST({c} AS DOUBLE)) AS sd{i}, "
                   f"quantile_cont(CAST({c} AS DOUBLE), 0.001) AS lo{i}, "
                   f"quantile_cont(CAST({c} AS DOUBLE), 0.999) AS hi{i}" for i, c in enumerate(cols))
    return f"SELECT {st} FROM ff"


def _outlier_body(cols=OUTLIER_COLS) -> str:
    parts = []
    for i, c in enumerate(cols):
        x = f"CAST({c} AS DOUBLE)"
        z = f"COALESCE(sd{i} > 0 AND abs({x} - mu{i}) / sd{i} > 3.0, false)"
        p = f"COALESCE({x} > hi{i} OR {x} < lo{i}, false)"
        parts.append(f"SELECT '{c}' AS \"column\", count_if(({z}) OR ({p})) AS outlier_count, "
                     f"count_if({z}) AS z_score_outliers, count_if({p}) AS percentile_outliers, "
                     f"COUNT({c}) AS total_values FROM ff, st")
    return f"""SELECT *, outlier_count / total_values AS outlier_percentage, outlier_count / total_values > 0.01 AS is_anomaly,
  CASE WHEN outlier_count / total_values > 0.01 THEN (CASE WHEN outlier_count / total_values > 0.05 THEN 'high'
       ELSE 'medium' END) END AS severity
FROM ({' UNION ALL '.join(parts)}) o WHERE total_values > 0"""


def _outlier_sql() -> str:
    return ff(_outlier_body(), [("st", _outlier_stats())])


@register("outliers", _outlier_sql())
def q_outliers(spark, sf_dir):
    return Q.outliers(features_table(spark, sf_dir, columns=list(OUTLIER_COLS)))


GAPS_SQL = """SELECT store_id, product_id, count_if(diff > 1) AS gap_count,
  COALESCE(MAX(CASE WHEN diff > 1 THEN diff END), 0) AS max_gap_days, COUNT(*) AS total_days,
  MIN(as_of_date) AS start, MAX(as_of_date) AS "end", store_id || '_' || product_id AS series_id,
  count_if(diff > 1) > 0 AS is_anomaly,
  CASE WHEN count_if(diff > 1) > 0 THEN (CASE WHEN count_if(diff > 1) > 5 THEN 'high' ELSE 'medium' END) END
    AS severity
FROM (SELECT store_id, product_id, as_of_date,
             CAST(date_diff('day', lag(as_of_date) OVER (PARTITION BY store_id, product_id ORDER BY as_of_date),
                            as_of_date) AS INTEGER) AS diff FROM ff) d
GROUP BY store_id, product_id"""


@register("date_gaps", ff(GAPS_SQL))
def q_date_gaps(spark, sf_dir):
    return Q.date_gaps(features_v2_df(spark, sf_dir))


def _summary_sql() -> str:
    return ff("""SELECT mm + oo + gg AS total_anomaly_types, mm AS missingness_anomalies, oo AS outlier_anomalies,
       gg AS date_gap_anomalies, mm + oo + gg > 0 AS has_critical_anomalies
FROM (SELECT count_if(is_anomaly) AS mm FROM m), (SELECT count_if(is_anomaly) AS oo FROM o),
     (SELECT count_if(is_anomaly) AS gg FROM g)""",
              [("st", _outlier_stats()), ("m", _missing_body()), ("o", _outlier_body()), ("g", GAPS_SQL)])


@register("anomaly_summary", _summary_sql())
def q_anomaly_summary(spark, sf_dir):
    return Q.anomaly_summary(features_v2_df(spark, sf_dir))


def _expect_sql() -> str:
    present = [c for c in Q.CRITICAL_COLUMNS if c in FEATURE_OUT]
    rows = [f"SELECT 'column_exists' AS rule, '{c}' AS \"column\", CAST(NULL AS BIGINT) AS element_count, "
            f"CAST(0 AS BIGINT) AS unexpected_count, 'pass' AS status" for c in present]
    rows.append("SELECT 'not_null', 'as_of_date', COUNT(*), count_if(as_of_date IS NULL), "
                "CASE WHEN count_if(as_of_date IS NULL) = 0 THEN 'pass' ELSE 'fail' END FROM ff")
    rows.append("SELECT 'not_null', 'y', COUNT(*), count_if(y IS NULL), "
                "CASE WHEN count_if(y IS NULL) = 0 THEN 'pass' ELSE 'fail' END FROM ff")
    rows.append("SELECT 'between_min_0', 'units_sold', NULL, NULL, 'skipped'")
    rows.append("SELECT 'greater_than_0', 'price', NULL, NULL, 'skipped'")
    rows.append("SELECT 'in_set_0_1', 'holiday_promotion', COUNT(*), "
                "count_if(COALESCE(holiday_promotion NOT IN (0, 1), false)), "
                "CASE WHEN count_if(COALESCE(holiday_promotion NOT IN (0, 1), false)) = 0 THEN 'pass' "
                "ELSE 'fail' END FROM ff")
    rows.append("SELECT 'compound_unique', 'as_of_date,store_id,product_id', (SELECT COUNT(*) FROM ff), "
                "CAST(COALESCE(SUM(CASE WHEN n > 1 THEN n END), 0) AS BIGINT), "
                "CASE WHEN COALESCE(SUM(CASE WHEN n > 1 THEN n END), 0) = 0 THEN 'pass' ELSE 'fail' END "
                "FROM (SELECT COUNT(*) AS n FROM ff GROUP BY as_of_date, store_id, product_id) k")
    return ff("\nUNION ALL\n".join(rows))


@register("expectations", _expect_sql())
def q_expectations(spark, sf_dir):
    return Q.expectations(features_table(spark, sf_dir))


def _retail_outlier_sql() -> str:
    from shelfcast.plans.sqlbase import RETAIL_DAILY
    cols = ("units_sold", "price", "inventory_level")
    body = _outlier_body(cols).replace("FROM ff, st", "FROM rd AS ff, st")
    stats = _outlier_stats(cols).replace("FROM ff", "FROM rd")
    return f"WITH rd AS ({RETAIL_DAILY}),\n st AS ({stats})\n{body}"


@register("outliers_retail", _retail_outlier_sql())
def q_outliers_retail(spark, sf_dir):
    """Q05-Q07 on the daily table: units, price (continuous: exact bracketed
    percentiles) and inventory level."""
    from shelfcast.plans import tables as TB
    return Q.outliers(TB.retail(spark, sf_dir), cols=["units_sold", "price", "inventory_level"])

"""Data quality and anomaly operators (Q01-Q10).

Every operator is one aggregation over all its columns followed by a reshape
to long form (array of structs + explode), never one job per column.  Global
statistics are one-row frames attached by broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast import config as C
from shelfcast.functions.joins import attach_row
from shelfcast.session import cut_lineage

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType, T.BooleanType)


def schema_dump(df: DataFrame) -> list[tuple[str, str]]:
    """Q01: column -> type (metadata only)."""
    return list(df.dtypes)


def _is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, _NUMERIC)


def _long(rows: list[Column], alias: str = "e") -> Column:
    return F.explode(F.array(*rows)).alias(alias)


Report = tuple[list[Column], list[Column]]  # aggregates over a table, and the report's rows over their one row


def column_stats(df: DataFrame) -> DataFrame:
    """Q02: mean, sample std, min, max (numeric columns) and null share of every column."""
    aggs, entries = _stats_report(df)
    return df.agg(*aggs).select(_long(entries)).select("e.*")


def _stats_report(df: DataFrame) -> Report:
    aggs, entries = [F.count(F.lit(1)).alias("__rows")], []
    for i, c in enumerate(df.columns):
        num = _is_numeric(df, c)
        x = F.col(c).cast("double") if num else None
        aggs += [F.avg(x).alias(f"m{i}") if num else F.lit(None).cast("double").alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}") if num else F.lit(None).cast("double").alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}") if num else F.lit(None).cast("double").alias(f"lo{i}"),
                 F.max(x).alias(f"hi{i}") if num else F.lit(None).cast("double").alias(f"hi{i}"),
                 F.count_if(F.col(c).isNull()).alias(f"n{i}")]
        entries.append(F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("mean"),
                                F.col(f"s{i}").alias("std"), F.col(f"lo{i}").alias("min"),
                                F.col(f"hi{i}").alias("max"),
                                (F.col(f"n{i}") / F.col("__rows")).alias("null_pct")))
    return aggs, entries


def missingness(df: DataFrame, threshold: float = C.MISSING_THRESHOLD) -> DataFrame:
    """Q04: null count/share per column; anomaly if share > threshold (strict)."""
    one = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)])
    return _missingness_of(df, one, threshold)


def _missingness_of(df: DataFrame, one: DataFrame, threshold: float) -> DataFrame:
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("null_count"),
                        F.col("__rows").alias("total_count")) for i, c in enumerate(df.columns)]
    out = one.select(_long(entries)).select("e.*")
    share = (F.col("null_count") / F.col("total_count")).cast("double")
    return out.withColumns({
        "null_percentage": share,
        "is_anomaly": share > F.lit(threshold),
        "severity": F.when(share > F.lit(threshold), F.when(share > 0.1, "high").otherwise("medium")),
    })


def outliers(df: DataFrame, cols: Sequence[str] = C.OUTLIER_COLUMNS, z: float = C.Z_THRESHOLD,
             low: float = C.PCT_LOW, high: float = C.PCT_HIGH, approx: bool = False,
             share_threshold: float = C.OUTLIER_SHARE_THRESHOLD) -> DataFrame:
    """Q05-Q07: z-score (population std) or percentile outliers per column.

    Pass 1 is one global aggregate of mean and population std; the two exact
    percentiles (linear interpolation) of all columns come from
    ``exact_quantiles_of`` (approximate brackets + exact counting: no value map,
    bounded driver payload); ``approx=True`` uses ``percentile_approx``.
    Pass 2 counts outliers with the statistics attached as constants.  Nulls
    are dropped per column; zero variance gives no z outliers.
    """
    from shelfcast.functions.quantiles import exact_quantiles_of
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df.sparkSession.createDataFrame(
            [], "column string, outlier_count bigint, z_score_outliers bigint, percentile_outliers bigint, "
                "total_values bigint, outlier_percentage double, is_anomaly boolean, severity string")
    st = []
    exact = {} if approx else exact_quantiles_of(df, cols, [low, high])
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        if approx:
            pct = F.percentile_approx(x, [low, high], 10000)
        else:
            pct = F.array(*[F.lit(v).cast("double") for v in exact[c]])
        st += [F.avg(x).alias(f"mu{i}"), F.stddev_pop(x).alias(f"sd{i}"), pct.alias(f"p{i}")]
    stats = df.agg(*st)
    j = attach_row(df.select(*cols), stats)
    counts, entries = [], []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        sd = F.col(f"sd{i}")
        zo = F.coalesce((sd > 0) & (F.abs(x - F.col(f"mu{i}")) / sd > F.lit(z)), F.lit(False))
        po = F.coalesce((x > F.col(f"p{i}")[1]) | (x < F.col(f"p{i}")[0]), F.lit(False))
        counts += [F.count_if(zo).alias(f"z{i}"), F.count_if(po).alias(f"q{i}"),
                   F.count_if(zo | po).alias(f"o{i}"), F.count(x).alias(f"t{i}")]
        entries.append(F.struct(F.lit(c).alias("column"), F.col(f"o{i}").alias("outlier_count"),
                                F.col(f"z{i}").alias("z_score_outliers"),
                                F.col(f"q{i}").alias("percentile_outliers"),
                                F.col(f"t{i}").alias("total_values")))
    one = j.agg(*counts)
    out = one.select(_long(entries)).select("e.*").filter(F.col("total_values") > 0)
    share = F.col("outlier_count") / F.col("total_values")
    return out.withColumns({
        "outlier_percentage": share.cast("double"),
        "is_anomaly": share > F.lit(share_threshold),
        "severity": F.when(share > F.lit(share_threshold), F.when(share > 0.05, "high").otherwise("medium")),
    })


def date_gaps(df: DataFrame, date_col: str = "as_of_date", keys: Sequence[str] = ("store_id", "product_id"),
              gap: int = C.GAP_DAYS) -> DataFrame:
    """Q08 (with W08): gaps > ``gap`` days between consecutive rows of each series."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy("_d")
    d = df.select(*keys, F.col(date_col).cast("date").alias("_d"))
    d = d.withColumn("_diff", F.datediff("_d", F.lag("_d").over(w)))
    big = F.col("_diff") > gap
    g = d.groupBy(*keys).agg(
        F.count_if(big).alias("gap_count"),
        F.coalesce(F.max(F.when(big, F.col("_diff"))), F.lit(0)).alias("max_gap_days"),
        F.count(F.lit(1)).alias("total_days"),
        F.min("_d").alias("start"), F.max("_d").alias("end"))
    return g.withColumns({
        "series_id": F.concat_ws("_", *[F.col(k).cast("string") for k in keys]),
        "is_anomaly": F.col("gap_count") > 0,
        "severity": F.when(F.col("gap_count") > 0,
                           F.when(F.col("gap_count") > 5, "high").otherwise("medium")),
    })


def anomaly_summary(df: DataFrame, missing_threshold: float = C.MISSING_THRESHOLD,
                    z: float = C.Z_THRESHOLD, gap: int = C.GAP_DAYS) -> DataFrame:
    """Q09: flagged columns (missingness, outliers) + flagged series (gaps), one row.

    ``df`` is run once: null counts of all columns are observed while the few columns that outliers and
    gaps read are staged.
    """
    counts = [F.count(F.lit(1)).alias("__rows"), *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]]
    seen = Observation()
    read = ["store_id", "product_id", "as_of_date", *[c for c in C.OUTLIER_COLUMNS if c in df.columns]]
    few = cut_lineage(df.observe(seen, *counts).select(*read))
    schema = df.agg(*counts).schema
    one = df.sparkSession.createDataFrame([tuple(seen.get[f.name] for f in schema)], schema)
    m = _missingness_of(df, one, missing_threshold).agg(F.count_if("is_anomaly").alias("missingness_anomalies"))
    o = outliers(few, z=z).agg(F.count_if("is_anomaly").alias("outlier_anomalies"))
    g = date_gaps(few, gap=gap).agg(F.count_if("is_anomaly").alias("date_gap_anomalies"))
    s = attach_row(attach_row(m, o), g)
    total = F.col("missingness_anomalies") + F.col("outlier_anomalies") + F.col("date_gap_anomalies")
    return s.select(total.alias("total_anomaly_types"), "missingness_anomalies", "outlier_anomalies",
                    "date_gap_anomalies", (total > 0).alias("has_critical_anomalies"))


def anomaly_gate(summary: DataFrame, max_anomalies: int = 0) -> dict:
    """Q10: fail when the total exceeds the limit (driver check of one row)."""
    row = summary.first().asDict()
    if row["total_anomaly_types"] > max_anomalies:
        raise RuntimeError(f"Anomaly gate failed: {row['total_anomaly_types']} anomaly types "
                           f"> limit {max_anomalies}: {row}")
    return row


CRITICAL_COLUMNS = ["as_of_date", "store_id", "product_id", "units_sold", "price", "discount",
                    "holiday_promotion", "competitor_pricing", "weather_condition", "seasonality",
                    "units_ordered", "y"]


def expectations(df: DataFrame, unique_keys: Sequence[str] = ("as_of_date", "store_id", "product_id")) -> DataFrame:
    """Q03: expectation suite as one row per rule (element / unexpected counts, status).

    Conditional counts come from one aggregate; key uniqueness from one
    group-by on the keys (partial aggregation; rows in duplicated keys).
    Rules on absent columns are reported as ``skipped`` (D9).
    """
    aggs, _ = _rules_report(df, unique_keys)
    return _expectations_of(df, df.agg(*aggs), unique_keys)


def _expectations_of(df: DataFrame, one: DataFrame, unique_keys: Sequence[str]) -> DataFrame:
    """The suite from the one row of conditional counts, and key uniqueness from ``df``."""
    _, entries = _rules_report(df, unique_keys)
    keys = [k for k in unique_keys if k in df.columns]
    dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
             .agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long").alias("__dups")))
    return attach_row(one, dup).select(_long(entries)).select("e.*")


def _rules_report(df: DataFrame, unique_keys: Sequence[str]) -> Report:
    cols = set(df.columns)
    rules: list[tuple[str, str, Column | None, Column | None]] = []
    for c in CRITICAL_COLUMNS:
        if c in cols:
            rules.append(("column_exists", c, None, None))
    rules.append(("not_null", "as_of_date", F.col("as_of_date").isNull() if "as_of_date" in cols else None, None))
    rules.append(("not_null", "y", F.col("y").isNull() if "y" in cols else None, None))
    rules.append(("between_min_0", "units_sold",
                  (F.col("units_sold") < 0) if "units_sold" in cols else None, None))
    rules.append(("greater_than_0", "price", (F.col("price") <= 0) if "price" in cols else None, None))
    rules.append(("in_set_0_1", "holiday_promotion",
                  (~F.col("holiday_promotion").isin(0, 1)) if "holiday_promotion" in cols else None, None))
    aggs = [F.count(F.lit(1)).alias("__rows")]
    entries = []
    for i, (rule, c, bad, _) in enumerate(rules):
        if rule == "column_exists":
            entries.append(F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("column"),
                                    F.lit(None).cast("long").alias("element_count"),
                                    F.lit(0).cast("long").alias("unexpected_count"),
                                    F.lit("pass").alias("status")))
            continue
        if bad is None:
            entries.append(F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("column"),
                                    F.lit(None).cast("long").alias("element_count"),
                                    F.lit(None).cast("long").alias("unexpected_count"),
                                    F.lit("skipped").alias("status")))
            continue
        # null values do not count against value rules (only not_null counts them)
        aggs.append(F.count_if(F.coalesce(bad, F.lit(False))).alias(f"u{i}"))
        entries.append(F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("column"),
                                F.col("__rows").alias("element_count"),
                                F.col(f"u{i}").alias("unexpected_count"),
                                F.when(F.col(f"u{i}") == 0, "pass").otherwise("fail").alias("status")))
    keys = [k for k in unique_keys if k in cols]
    entries.append(F.struct(F.lit("compound_unique").alias("rule"), F.lit(",".join(keys)).alias("column"),
                            F.col("__rows").alias("element_count"), F.col("__dups").alias("unexpected_count"),
                            F.when(F.col("__dups") == 0, "pass").otherwise("fail").alias("status")))
    return aggs, entries


class Observed:
    """Q02, Q03 (the value rules) and Q04 collected by the write of a table itself.

    ``watch(df)`` is ``df`` with the aggregates of all three reports observed; once an action has run over it, the
    reports come from that one row of metrics, without another pass.  ``expectations`` reads the keys of the
    stored table for the uniqueness rule.
    """

    def __init__(self, unique_keys: Sequence[str] = ("as_of_date", "store_id", "product_id")):
        self.keys = unique_keys
        self.observation = Observation()
        self.df: DataFrame | None = None

    def watch(self, df: DataFrame) -> DataFrame:
        stats, _ = _stats_report(df)
        rules, _ = _rules_report(df, self.keys)
        self.df = df
        self.schema = df.agg(*stats, *rules[1:]).schema  # the rules' row count is that of the statistics
        return df.observe(self.observation, *stats, *rules[1:])

    def _one(self) -> DataFrame:
        got = self.observation.get
        return self.df.sparkSession.createDataFrame([tuple(got.get(f.name) for f in self.schema)], self.schema)

    def column_stats(self) -> DataFrame:
        return self._one().select(_long(_stats_report(self.df)[1])).select("e.*")

    def missingness(self, threshold: float = C.MISSING_THRESHOLD) -> DataFrame:
        return _missingness_of(self.df, self._one(), threshold)

    def expectations(self, stored: DataFrame) -> DataFrame:
        return _expectations_of(stored.select(*self.df.columns), self._one(), self.keys)

"""Chronological splits, walk-forward folds, scaling and series codes.

Cut points come from one-row aggregates attached by broadcast; fold
membership is an ``explode`` of the (at most n_folds) folds a row belongs
to, computed arithmetically from the attached bounds, so no nested-loop or
cross join is planned.  Series codes are a distributed dense index
(range-partitioned sort + per-partition offsets), not a single-partition
window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast import config as C
from shelfcast.functions import scalar as S
from shelfcast.functions.joins import attach_row, bounded_broadcast
from shelfcast.session import ensure_checkpoint_dir


def split_cuts(df: DataFrame, date_col: str = "as_of_date", train_frac: float = C.TRAIN_FRAC,
               val_frac: float = C.VAL_FRAC) -> DataFrame:
    """One row: train_end and val_end dates over the sorted distinct dates.

    train = first int(n * train_frac) dates, val up to int(n * (train + val)).
    The distinct-date array is bounded by the calendar (one entry per day),
    not by the row count; partial aggregation dedups it map side.
    """
    if train_frac + val_frac >= 1.0:
        raise ValueError("train_frac + val_frac must be < 1.0")
    dates = df.agg(F.sort_array(F.collect_set(F.col(date_col).cast("date"))).alias("_dates"))
    n = F.size("_dates")
    i_train = F.floor(n * F.lit(float(train_frac))).cast("int")
    i_val = F.floor(n * F.lit(float(train_frac + val_frac))).cast("int")
    return dates.select(F.element_at("_dates", i_train).alias("train_end"),
                        F.element_at("_dates", i_val).alias("val_end"),
                        F.element_at("_dates", n).alias("test_end"))


def chronological_split(df: DataFrame, date_col: str = "as_of_date", train_frac: float = C.TRAIN_FRAC,
                        val_frac: float = C.VAL_FRAC) -> DataFrame:
    """Add ``split`` in {train, val, test} (no gap, no overlap)."""
    cuts = split_cuts(df, date_col, train_frac, val_frac).select("train_end", "val_end")
    d = F.col(date_col).cast("date")
    lab = F.when(d <= F.col("train_end"), "train").when(d <= F.col("val_end"), "val").otherwise("test")
    return attach_row(df, cuts).withColumn("split", lab).drop("train_end", "val_end")


def split_summary(split_df: DataFrame, date_col: str = "as_of_date") -> DataFrame:
    """Rows, end date and percentage (1 dp) per split."""
    g = split_df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"),
                                      F.max(F.col(date_col).cast("date")).alias("end_date"))
    tot = g.agg(F.sum("rows").alias("_total"))
    return attach_row(g, tot).select(
        "split", "rows", "end_date",
        S.round_half_even(F.col("rows") / F.col("_total") * F.lit(100.0), 1).alias("pct"))


def split_checks(split_df: DataFrame, date_col: str = "as_of_date") -> DataFrame:
    """Non-empty splits, no date overlap, full coverage; one row per check."""
    d = F.col(date_col).cast("date")
    agg = split_df.agg(
        *[F.count_if(F.col("split") == s).alias(f"n_{s}") for s in ("train", "val", "test")],
        *[F.max(F.when(F.col("split") == s, d)).alias(f"max_{s}") for s in ("train", "val")],
        *[F.min(F.when(F.col("split") == s, d)).alias(f"min_{s}") for s in ("val", "test")],
        F.count(F.lit(1)).alias("n_all"))
    checks = [
        ("train_not_empty", F.col("n_train") > 0),
        ("val_not_empty", F.col("n_val") > 0),
        ("test_not_empty", F.col("n_test") > 0),
        ("train_before_val", F.coalesce(F.col("max_train") < F.col("min_val"), F.lit(True))),
        ("val_before_test", F.coalesce(F.col("max_val") < F.col("min_test"), F.lit(True))),
        ("full_coverage", F.col("n_train") + F.col("n_val") + F.col("n_test") == F.col("n_all")),
    ]
    return agg.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), c.alias("passed"))
                                          for n, c in checks])).alias("c")).select("c.*")


def fold_bounds(df: DataFrame, date_col: str = "as_of_date", n_splits: int = C.N_FOLDS,
                gap_days: int = C.FOLD_GAP_DAYS, val_days: int = C.FOLD_VAL_DAYS) -> DataFrame:
    """One row of fold arithmetic (min, max, step) from the data's date range."""
    b = df.agg(F.min(F.col(date_col).cast("date")).alias("min_date"),
               F.max(F.col(date_col).cast("date")).alias("max_date"))
    usable = F.datediff("max_date", "min_date") - F.lit(val_days + gap_days)
    # Python floor division of a possibly negative number
    return b.withColumn("step_days", F.floor(usable / F.lit(n_splits)).cast("int"))


def fold_table(bounds: DataFrame, n_splits: int = C.N_FOLDS, gap_days: int = C.FOLD_GAP_DAYS,
               val_days: int = C.FOLD_VAL_DAYS) -> DataFrame:
    """The fold windows (at most n_splits rows), stopping at the first fold whose
    validation would start at or after the last date."""
    i = F.explode(F.sequence(F.lit(1), F.lit(n_splits))).alias("fold_number")
    f = bounds.select("min_date", "max_date", "step_days", i)
    train_end = F.date_add("min_date", F.col("step_days") * F.col("fold_number"))
    f = f.withColumn("train_end", train_end).withColumn("val_start", F.date_add("train_end", gap_days))
    f = f.withColumn("val_end", F.least(F.date_add("val_start", val_days), F.col("max_date")))
    # break at the first fold with val_start >= max_date: later folds are dropped too
    stop = F.min(F.when(F.col("val_start") >= F.col("max_date"), F.col("fold_number"))).over(
        Window.partitionBy("min_date"))
    return (f.withColumn("_stop", stop)
             .filter(F.col("_stop").isNull() | (F.col("fold_number") < F.col("_stop")))
             .select("fold_number", F.col("min_date").alias("train_start"), "train_end", "val_start", "val_end"))


def fold_membership(df: DataFrame, date_col: str = "as_of_date", n_splits: int = C.N_FOLDS,
                    gap_days: int = C.FOLD_GAP_DAYS, val_days: int = C.FOLD_VAL_DAYS) -> DataFrame:
    """Rows x folds as ``(fold_number, role)`` per row (a row may be in many folds).

    The fold table has at most ``n_splits`` rows (a proven bound); it is
    attached to every row as one array and the row's memberships are an
    ``explode`` of a filter over it: train ``date <= train_end``, validation
    ``val_start < date <= val_end``.
    """
    folds = fold_table(fold_bounds(df, date_col, n_splits, gap_days, val_days), n_splits, gap_days, val_days)
    arr = folds.agg(F.collect_list(F.struct("fold_number", "train_end", "val_start", "val_end")).alias("_folds"))
    d = F.col(date_col).cast("date")
    j = attach_row(df, arr)
    tr = F.transform(F.filter("_folds", lambda f: d <= f["train_end"]),
                     lambda f: F.struct(f["fold_number"].alias("fold_number"), F.lit("train").alias("role")))
    va = F.transform(F.filter("_folds", lambda f: (d > f["val_start"]) & (d <= f["val_end"])),
                     lambda f: F.struct(f["fold_number"].alias("fold_number"), F.lit("val").alias("role")))
    out = j.withColumn("_m", F.explode(F.concat(tr, va))).drop("_folds")
    return out.select("*", "_m.*").drop("_m")


def walk_forward_folds(df: DataFrame, date_col: str = "as_of_date", n_splits: int = C.N_FOLDS,
                       gap_days: int = C.FOLD_GAP_DAYS, val_days: int = C.FOLD_VAL_DAYS) -> DataFrame:
    """Fold windows with train/val row counts; empty folds are skipped."""
    m = fold_membership(df, date_col, n_splits, gap_days, val_days)
    counts = m.groupBy("fold_number").agg(F.count_if(F.col("role") == "train").alias("n_train"),
                                          F.count_if(F.col("role") == "val").alias("n_val"))
    folds = fold_table(fold_bounds(df, date_col, n_splits, gap_days, val_days), n_splits, gap_days, val_days)
    return (folds.join(counts, "fold_number", "inner")
                 .filter((F.col("n_train") > 0) & (F.col("n_val") > 0)))


def dense_index(values: DataFrame, col: str, out: str = "code", partitions: int | None = None) -> DataFrame:
    """Distinct values of ``col`` with their 0-based position in sorted order.

    Distributed: the distinct values are range-partitioned and sorted; each
    partition's size is counted (one small row per partition) and the
    offsets are prefix sums over that short array; a value's code is its
    partition offset plus its row number inside the partition (a window
    keyed by partition id).  No single-partition window, nothing collected.
    """
    spark = values.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the distinct values are materialised once (reliable checkpoint): the
    # range sampling, the partition sizes and the ranking then read this
    # small table instead of re-running the pipeline that produced them
    ensure_checkpoint_dir(spark)
    distinct = values.select(col).filter(F.col(col).isNotNull()).distinct().checkpoint(eager=True)
    d = distinct.repartitionByRange(n, col).withColumn("_pid", F.spark_partition_id())
    sizes = d.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offs = sizes.agg(F.sort_array(F.collect_list(F.struct("_pid", "_n"))).alias("_s")).select(
        F.transform("_s", lambda e, i: F.struct(
            e["_pid"].alias("_pid"),
            F.aggregate(F.slice("_s", 1, i), F.lit(0).cast("long"), lambda acc, x: acc + x["_n"]).alias("_off")))
        .alias("_o")).select(F.explode("_o").alias("o")).select("o.*")
    w = Window.partitionBy("_pid").orderBy(col)
    ranked = d.withColumn("_rn", F.row_number().over(w))
    return (ranked.join(F.broadcast(offs), "_pid", "inner")
                  .select(col, (F.col("_off") + F.col("_rn") - 1).cast("int").alias(out)))


def encode_series(train: DataFrame, *others: DataFrame, col: str = "series_id",
                  out: str = "series_enc") -> tuple[DataFrame, ...]:
    """W13 + J06: code = rank of the id among sorted distinct train ids; unseen -> -1.

    Returns (mapping, train, *others) with ``out`` added.  The mapping has
    one row per series; it is broadcast only under a checked row bound.
    """
    mapping = dense_index(train, col, out)
    m = bounded_broadcast(mapping)
    enc = [d.join(m, col, "left").withColumn(out, F.coalesce(F.col(out), F.lit(-1)))
           for d in (train, *others)]
    return (mapping, *enc)


def scaler_stats(train: DataFrame, cols: Sequence[str] = C.SCALED_COLUMNS) -> DataFrame:
    """M04 fit: per column mean and population std on train (nulls ignored); 0 std -> 1."""
    cols = [c for c in cols if c in train.columns]
    one = train.agg(*[F.avg(F.col(c).cast("double")).alias(f"mu_{c}") for c in cols],
                    *[F.stddev_pop(F.col(c).cast("double")).alias(f"sd_{c}") for c in cols])
    return one.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(f"mu_{c}").alias("mean"),
        F.when(F.col(f"sd_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"sd_{c}")).alias("std"))
        for c in cols])).alias("s")).select("s.*")


def apply_scaler(df: DataFrame, stats: DataFrame) -> DataFrame:
    """M04 transform: (x - mean) / std with the fitted statistics.

    The long statistics table is pivoted into one flat row (two columns per
    scaled column) and attached by broadcast, so the transform is plain
    column arithmetic inside whole-stage codegen.
    """
    cols = [c for c in C.SCALED_COLUMNS if c in df.columns]
    flat = stats.agg(*[F.first(F.when(F.col("column") == c, F.col("mean")), ignorenulls=True).alias(f"__mu_{c}")
                       for c in cols],
                     *[F.first(F.when(F.col("column") == c, F.col("std")), ignorenulls=True).alias(f"__sd_{c}")
                       for c in cols])
    j = attach_row(df, flat)
    scaled = {c: F.when(F.col(f"__sd_{c}").isNotNull(),
                        (F.col(c).cast("double") - F.col(f"__mu_{c}")) / F.col(f"__sd_{c}"))
                  .otherwise(F.col(c).cast("double")) for c in cols}
    return j.withColumns(scaled).drop(*[f"__mu_{c}" for c in cols], *[f"__sd_{c}" for c in cols])


def series_min_history(train: DataFrame, min_rows: int = C.MIN_SERIES_HISTORY, col: str = "series_id") -> DataFrame:
    """Series with at least ``min_rows`` training rows."""
    return train.groupBy(col).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") >= min_rows)


def series_missing_in_test(train: DataFrame, test: DataFrame, col: str = "series_id") -> DataFrame:
    """Series present in train and absent from test (left anti join)."""
    return train.select(col).distinct().join(test.select(col).distinct(), col, "left_anti")


def series_list(df: DataFrame, col: str = "series_id") -> DataFrame:
    """Sorted distinct series ids."""
    return df.select(col).distinct().orderBy(col)


def latest_history(df: DataFrame, n: int = 30, keys: Sequence[str] = ("store_id", "product_id"),
                   date_col: str = "date") -> DataFrame:
    """The latest ``n`` rows per series, positions re-numbered ascending.

    ``row_number() <= n`` over a descending date order is planned with a
    WindowGroupLimit ahead of the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(date_col).desc())
    t = df.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= n)
    cnt = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return t.withColumn("pos", (cnt - F.col("_rk") + 1).cast("int")).drop("_rk")


def fold_average(per_fold: DataFrame, metric_cols: Sequence[str] = ("mae", "rmse", "r2"),
                 group: Sequence[str] = ()) -> DataFrame:
    """Unweighted mean of per-fold metrics."""
    aggs = [F.avg(c).alias(f"avg_{c}") for c in metric_cols] + [F.count(F.lit(1)).alias("n_folds")]
    return per_fold.groupBy(*group).agg(*aggs) if group else per_fold.agg(*aggs)


def best_worst(per_series: DataFrame, metric: str = "mae", n: int = 3, col: str = "series_id") -> DataFrame:
    """N best and n worst series by a metric (ties by id)."""
    best = per_series.orderBy(F.col(metric).asc(), F.col(col).asc()).limit(n).withColumn("kind", F.lit("best"))
    worst = per_series.orderBy(F.col(metric).desc(), F.col(col).asc()).limit(n).withColumn("kind", F.lit("worst"))
    return best.unionByName(worst)

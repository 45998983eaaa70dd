"""Incremental retail ingest -> feature table (Structured Streaming).

New daily rows arrive as files; each micro-batch ``b`` is processed by
``foreachBatch`` and only touches the series it contains, and only their buckets:

* **append path** (the usual case: every new row is later than its series'
  last stored row): the features of the new rows — and of the last
  ``horizon`` stored rows, whose label just arrived — are computed over a
  look-back window of the last ``28 + horizon`` stored rows plus the new rows.
  Lags and rolling statistics need at most 28 rows back.  The EWM needs the
  whole series, so each stored row keeps its EWM state (the value including
  the row); the first look-back row feeds that state into the recurrence.
* **rewind path** (a row at or before the series' last stored date arrived
  late): the series is recomputed from its full history and gets a new
  epoch ``b``; rows it had in earlier batches are superseded.

Storage is append-only and idempotent by batch id (a replayed batch
overwrites its own ``batch_id=b`` partitions and reads only batches < b):
``hist/`` rows + EWM state, ``feat/`` emitted feature rows, ``epoch/``
rewound series, ``stats/`` the number of rows each series gained.  A row of a
series is valid when its batch id is at least the series' epoch.  The two
table-wide statistics (store shares, median lead time) are sums of the batches'
counts, taken and applied at read time (``read_features``), so earlier rows
never go stale, no batch scans the history for them, and no file is shared
between batches.  The checkpoint replaces the source's fingerprint file.

Layout: all tables but ``stats`` are partitioned by ``bucket``, a hash of the
series (``layout/`` keeps their number).  A batch names the buckets of its own
series, at most that many numbers, as a literal filter, so the scan of the
history is pruned to these folders.  :func:`compact` folds the batches so far into
``compacted/g=<batch>``: superseded rows and epochs go, a bucket is one file again.
A generation counts once its mark under ``compacted/done`` is written; readers
take the newest one below their batch and the batches after it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfcast.functions import scalar as S
from shelfcast.functions.ewm import ewm_adjust_false
from shelfcast.functions.joins import bounded_broadcast
from shelfcast.operators import features as FE
from shelfcast.session import cut_lineage
from shelfcast.sources.readers import RETAIL_SCHEMA, folder_exists, partition_values, remove_folder

KEYS = ["store_id", "product_id"]
LOOKBACK = 28
BUCKETS = 64


def bucket_of(n: int):
    return F.pmod(F.xxhash64(*KEYS), F.lit(n)).cast("int")


def layout(spark: SparkSession, base: str, buckets: int = BUCKETS) -> int:
    """The number of buckets of a store: fixed when it is first written."""
    p = os.path.join(base, "layout")
    if not folder_exists(spark, p):
        spark.createDataFrame([(buckets,)], "buckets int").write.parquet(p)
    return spark.read.parquet(p).first()["buckets"]


def _write(df: DataFrame, path: str, buckets: int) -> None:
    """One file per bucket."""
    df.withColumn("bucket", bucket_of(buckets)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)


def generation(spark: SparkSession, base: str, before: int | None = None) -> int | None:
    """The newest complete compacted generation (of batches below ``before``)."""
    done = partition_values(spark, os.path.join(base, "compacted", "done"), "g")
    return max((g for g in done if before is None or g < before), default=None)


def _later(spark: SparkSession, base: str, table: str, after: int | None, before: int | None) -> DataFrame | None:
    """Rows of the batches that no generation holds yet."""
    p = os.path.join(base, table)
    ids = [b for b in partition_values(spark, p, "batch_id") if (after is None or b > after) and (before is None or b < before)]
    if table != "stats":  # a batch without a row for a table leaves an empty folder
        ids = [b for b in ids if partition_values(spark, os.path.join(p, f"batch_id={b}"), "bucket")]
    if not ids:
        return None
    return spark.read.option("basePath", p).parquet(*[os.path.join(p, f"batch_id={b}") for b in ids]) \
        .withColumn("batch_id", F.col("batch_id").cast("long"))


def rows_of(spark: SparkSession, base: str, table: str, before: int | None = None,
            buckets: list[int] | None = None) -> DataFrame | None:
    """Valid rows of ``hist`` or ``feat`` from batches below ``before``; ``buckets`` prunes the scan to these folders."""
    g = generation(spark, base, before)
    folded = os.path.join(base, "compacted", f"g={g}", table)
    parts = [spark.read.parquet(folded)] if g is not None and partition_values(spark, folded, "bucket") else []
    later = _later(spark, base, table, g, before)
    parts += [] if later is None else [later]
    epochs = _later(spark, base, "epoch", g, before)
    if buckets is not None:
        parts = [d.filter(F.col("bucket").isin(buckets)) for d in parts]
        epochs = None if epochs is None else epochs.filter(F.col("bucket").isin(buckets))
    if not parts:
        return None
    d = (parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])).drop("bucket")
    if epochs is None:
        return d
    e = epochs.groupBy(*KEYS).agg(F.max("batch_id").alias("_epoch"))
    return (d.join(e, KEYS, "left")
             .filter(F.col("_epoch").isNull() | (F.col("batch_id") >= F.col("_epoch"))).drop("_epoch"))


def gained(spark: SparkSession, base: str, before: int | None = None) -> DataFrame:
    """Number of stored rows (n) of each series."""
    g = generation(spark, base, before)
    parts = [] if g is None else [spark.read.parquet(os.path.join(base, "compacted", f"g={g}", "stats"))]
    later = _later(spark, base, "stats", g, before)
    parts = [d.select(*KEYS, "n") for d in (*parts, *([] if later is None else [later]))]
    return (parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])).groupBy(*KEYS).agg(F.sum("n").alias("n"))


def committed(spark: SparkSession, checkpoint: str) -> int | None:
    """The last batch that the stream's checkpoint has committed."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(checkpoint, "commits"))
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return max((int(n) for n in names if n.isdigit()), default=None)


def compact(spark: SparkSession, base: str, checkpoint: str, remove: bool = False) -> int | None:
    """Fold all committed batches into a new generation; returns its number (None: nothing new to fold).

    A stream may go on meanwhile: batches above the generation are not touched, and a
    batch that is replayed reads the generation before it.  ``remove`` also removes what
    the generation replaces; then no reader may still be at work on it.
    """
    newest, old = committed(spark, checkpoint), generation(spark, base)
    folded = [b for b in partition_values(spark, os.path.join(base, "hist"), "batch_id") if newest is not None and b <= newest]
    if not folded or (old is not None and max(folded) <= old):
        return None
    g, n = max(folded), layout(spark, base)
    to = os.path.join(base, "compacted", f"g={g}")
    for table in ("hist", "feat"):
        _write(rows_of(spark, base, table, before=g + 1), os.path.join(to, table), n)
    gained(spark, base, before=g + 1).write.mode("overwrite").parquet(os.path.join(to, "stats"))
    spark.range(1).write.mode("overwrite").parquet(os.path.join(base, "compacted", "done", f"g={g}"))
    if remove:
        for table in ("hist", "feat", "epoch", "stats"):
            for b in partition_values(spark, os.path.join(base, table), "batch_id"):
                if b <= g:
                    remove_folder(spark, os.path.join(base, table, f"batch_id={b}"))
        for x in partition_values(spark, os.path.join(base, "compacted", "done"), "g"):
            if x < g:
                remove_folder(spark, os.path.join(base, "compacted", "done", f"g={x}"))
                remove_folder(spark, os.path.join(base, "compacted", f"g={x}"))
    return g


def _with_state(rows: DataFrame, ewm_input: str) -> DataFrame:
    """EWM state per row (value including the row) from ``ewm_input``."""
    return ewm_adjust_false(rows, ewm_input, KEYS, "date", out="ewm_state", shift=0)


def _process(snapshot: DataFrame, base: str, horizon: int, buckets: int):
    hist_p, feat_p, epoch_p = (os.path.join(base, t) for t in ("hist", "feat", "epoch"))

    def run(batch: DataFrame, b: int) -> None:
        spark = batch.sparkSession
        n_buckets = layout(spark, base, buckets)
        cols = [c for c in batch.columns]
        new = cut_lineage(FE.dedup_keep_first(batch, method="aggregate"))
        own = [r[0] for r in new.select(bucket_of(n_buckets)).distinct().collect()]  # at most the number of buckets
        hist = rows_of(spark, base, "hist", b, own)
        if hist is not None:
            hist = hist.drop("batch_id")
        touched = new.select(*KEYS).distinct()
        if hist is None:
            h_t = None
            fresh, late_keys = new, None
        else:
            h_t = hist.join(touched, KEYS, "left_semi")
            known = h_t.select(*KEYS, "date")
            fresh = new.join(known, KEYS + ["date"], "left_anti")      # a re-delivered day keeps the first copy
            last = h_t.groupBy(*KEYS).agg(F.max("date").alias("_last"))
            late_keys = cut_lineage(fresh.join(last, KEYS, "inner").filter(F.col("date") <= F.col("_last"))
                                    .select(*KEYS).distinct())
        out_hist, out_feat = [], []
        # what this batch adds to the table-wide statistics; readers fill in their values
        fresh.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite") \
             .parquet(os.path.join(base, "stats", f"batch_id={b}"))
        weights = spark.createDataFrame([], "store_id string, sample_weight double")
        med = spark.range(1).select(F.lit(None).cast("double").alias("lead_median"))
        # --- append path ------------------------------------------------------------------
        app_new = fresh if late_keys is None else fresh.join(late_keys, KEYS, "left_anti")
        if h_t is not None:
            h_app = h_t.join(late_keys, KEYS, "left_anti")
            wd = Window.partitionBy(*KEYS).orderBy(F.col("date").desc())
            tail = (h_app.withColumn("_rk", F.row_number().over(wd))
                         .filter(F.col("_rk") <= LOOKBACK + horizon))
            first = F.col("_rk") == F.max("_rk").over(Window.partitionBy(*KEYS))
            tail = tail.withColumns({
                "_ewm_in": F.when(first, F.col("ewm_state")).otherwise(F.col("units_sold").cast("double")),
                "_emit": F.col("_rk") <= horizon, "_new": F.lit(False)}).drop("_rk", "ewm_state")
        else:
            tail = None
        app = app_new.withColumns({"_ewm_in": F.col("units_sold").cast("double"),
                                   "_emit": F.lit(True), "_new": F.lit(True)})
        frame = app if tail is None else tail.unionByName(app)
        f = FE.features_v2(frame, snapshot, horizon=horizon, include_created_at=False, weights=weights,
                           lead_median=med, ewm_value="_ewm_in", keep=["_emit"])
        out_feat.append(f.filter("_emit").drop("_emit"))
        st = _with_state(frame.filter("_new"), "_ewm_in") if tail is None else \
            _with_state(frame, "_ewm_in").filter("_new")
        out_hist.append(st.select(*cols, "ewm_state"))
        # --- rewind path (late rows): whole series recomputed under a new epoch ----------
        if late_keys is not None:
            rw = h_t.join(late_keys, KEYS, "left_semi").drop("ewm_state").select(*cols) \
                    .unionByName(fresh.join(late_keys, KEYS, "left_semi").select(*cols))
            out_feat.append(FE.features_v2(rw, snapshot, horizon=horizon, include_created_at=False,
                                           weights=weights, lead_median=med))
            rwd = FE.dedup_keep_first(rw, method="aggregate")
            out_hist.append(_with_state(rwd.withColumn("_x", F.col("units_sold").cast("double")), "_x")
                            .select(*cols, "ewm_state"))
            _write(late_keys, os.path.join(epoch_p, f"batch_id={b}"), n_buckets)
        h_out = out_hist[0] if len(out_hist) == 1 else out_hist[0].unionByName(out_hist[1])
        f_out = out_feat[0] if len(out_feat) == 1 else out_feat[0].unionByName(out_feat[1])
        _write(h_out, os.path.join(hist_p, f"batch_id={b}"), n_buckets)
        _write(f_out, os.path.join(feat_p, f"batch_id={b}"), n_buckets)
    return run


def start_ingest(spark: SparkSession, retail_dir: str, snapshot: DataFrame, base: str, checkpoint: str,
                 horizon: int = 1, max_files_per_trigger: int | None = None,
                 schema=RETAIL_SCHEMA, buckets: int = BUCKETS) -> StreamingQuery:
    """``buckets`` counts when the store is first written; later runs keep its number."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return (r.parquet(retail_dir).writeStream.foreachBatch(_process(snapshot, base, horizon, buckets))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_features(spark: SparkSession, base: str, snapshot: DataFrame) -> DataFrame:
    """The maintained features with the current table-wide statistics re-applied."""
    f = rows_of(spark, base, "feat")
    if f is None:
        raise ValueError(f"{base} holds no feature row yet")
    f = f.drop("batch_id", "sample_weight")
    counts = cut_lineage(gained(spark, base))                     # one row per series
    w = FE.store_weights(counts, counts_col="n")
    snap = snapshot.select(*KEYS, F.col("lead_time_days").cast("double").alias("_lead"))
    med = counts.join(snap, KEYS, "left").agg(F.percentile("_lead", F.lit(0.5), F.col("n"))).scalar()
    f = f.join(bounded_broadcast(w), "store_id", "left").join(snap, KEYS, "left")
    lead = F.coalesce(F.col("_lead"), med)
    return f.withColumns({
        "sample_weight": F.coalesce("sample_weight", F.lit(10.0)),
        "lead_time_days": lead,
        "lead_time_demand": S.clip_lower("sales_roll_mean_7", 0) * lead,
    }).drop("_lead")

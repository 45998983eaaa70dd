import os
import tempfile

from pyspark.sql import functions as F

from shelfcast.operators import features as FE
from shelfcast.operators import orders as OR
from shelfcast.sources import testdata as T
from shelfcast.streaming import ingest, ledger


def test_ledger_stream_matches_batch_and_ignores_duplicates(spark, sf_dir):
    base = tempfile.mkdtemp(prefix="ledger-")
    snap, ven = T.inventory_snapshot(spark, sf_dir), T.vendors(spark, sf_dir)
    docs = T.orders_nested(spark, sf_dir)
    months = [r[0] for r in docs.select(F.date_format("created_at", "yyyy").alias("m")).distinct()
              .orderBy("m").limit(3).collect()]
    src = os.path.join(base, "in")
    for i, m in enumerate(months):
        part = docs.filter(F.date_format("created_at", "yyyy") == m)
        part.write.mode("overwrite").parquet(os.path.join(src, f"f{i}"))
    # a duplicate delivery of the first file
    docs.filter(F.date_format("created_at", "yyyy") == months[0]).write.parquet(os.path.join(src, "dup"))
    led = os.path.join(base, "ledger")
    ledger.init_ledger(snap, led)
    q = ledger.start_ledger(spark, src + "/*", ven, led, os.path.join(base, "ck"))
    q.awaitTermination()
    got = ledger.current_snapshot(spark, led)
    used = docs.filter(F.date_format("created_at", "yyyy").isin(months))
    lines = used.select("order_id", "store_id", F.explode("items").alias("i")).select(
        "order_id", "store_id", "i.product_id", "i.quantity")
    exp = OR.apply_receipts(snap, OR.order_pricing(lines, snap, ven))
    key = ["store_id", "product_id"]
    a = got.select(*key, "current_stock", "total_units_received").orderBy(*key).collect()
    b = exp.select(*key, "current_stock", "total_units_received").orderBy(*key).collect()
    assert a == b


def _files(spark, sf_dir, src, years=2, per_year=4):
    """Order documents as ``per_year`` files for each of the first years; returns (documents, file paths in order)."""
    docs = T.orders_nested(spark, sf_dir)
    first = [r[0] for r in docs.select(F.year("created_at").alias("y")).distinct().orderBy("y").limit(years).collect()]
    used = docs.filter(F.year("created_at").isin(first)).withColumn("y", F.year("created_at"))
    used = used.withColumn("k", F.pmod(F.xxhash64("order_id"), F.lit(per_year)))
    paths = []
    for y in first:
        for k in range(per_year):
            p = os.path.join(src, f"{y}-{k}")
            used.filter((F.col("y") == y) & (F.col("k") == k)).drop("y", "k").coalesce(1).write.parquet(p)
            paths.append(p)
    return used.drop("y", "k"), paths


def _touch_in_order(paths):
    """The file source takes files by modification time."""
    for i, p in enumerate(paths):
        for f in os.listdir(p):
            os.utime(os.path.join(p, f), (1_700_000_000 + 10 * i,) * 2)


def test_ledger_takes_late_files_and_repeats_of_earlier_batches(spark, sf_dir):
    base = tempfile.mkdtemp(prefix="ledger-")
    src, led = os.path.join(base, "in"), os.path.join(base, "ledger")
    snap, ven = T.inventory_snapshot(spark, sf_dir, drop_missing=True), T.vendors(spark, sf_dir)
    docs, paths = _files(spark, sf_dir, src)
    repeat = os.path.join(src, "repeat")
    spark.read.parquet(paths[3]).coalesce(1).write.parquet(repeat)
    _touch_in_order([*reversed(paths), repeat])  # newest year first, one file per batch, a repeat at the end
    ledger.init_ledger(snap, led)
    q = ledger.start_ledger(spark, src + "/*", ven, led, os.path.join(base, "ck"), max_files_per_trigger=1)
    q.awaitTermination()
    lines = docs.select("order_id", "store_id", F.explode("items").alias("i")).select(
        "order_id", "store_id", "i.product_id", "i.quantity")
    exp = OR.apply_receipts(snap, OR.order_pricing(lines, snap, ven))
    cols = ["store_id", "product_id", "current_stock", "total_units_received"]
    assert sorted(ledger.current_snapshot(spark, led).select(*cols).collect()) == sorted(exp.select(*cols).collect())
    applied = spark.read.parquet(led + "_applied")
    assert applied.count() == applied.select("order_id").distinct().count() == docs.count()
    assert applied.select("batch").distinct().count() >= 8


def _run_ingest(spark, sf_dir, order):
    base = tempfile.mkdtemp(prefix="ingest-")
    retail = T.retail_daily(spark, sf_dir)
    snap = T.inventory_snapshot(spark, sf_dir)
    years = [r[0] for r in retail.select(F.year("date").alias("y")).distinct().orderBy("y").collect()]
    src = os.path.join(base, "in")
    for i, y in enumerate(order(years)):
        retail.filter(F.year("date") == y).write.parquet(os.path.join(src, f"f{i:03d}"))
    q = ingest.start_ingest(spark, src + "/*", snap, os.path.join(base, "state"), os.path.join(base, "ck"),
                            max_files_per_trigger=1, schema=retail.schema)
    q.awaitTermination()
    got = ingest.read_features(spark, os.path.join(base, "state"), snap).toPandas()
    exp = FE.features_v2(retail, snap, include_created_at=False).toPandas()
    key = ["store_id", "product_id", "as_of_date"]
    got = got[exp.columns].sort_values(key).reset_index(drop=True)
    exp = exp.sort_values(key).reset_index(drop=True)
    assert len(got) == len(exp)
    num = [c for c in exp.columns if exp[c].dtype.kind in "fi"]
    assert ((got[num] - exp[num]).abs().max().max()) < 1e-9
    assert (got[key] == exp[key]).all().all()


def test_incremental_ingest_in_order_matches_batch(spark, sf_dir):
    _run_ingest(spark, sf_dir, lambda ys: ys)


def test_incremental_ingest_with_late_files_matches_batch(spark, sf_dir):
    # the second year arrives after the fourth: its series are rewound and rebuilt
    _run_ingest(spark, sf_dir, lambda ys: [ys[0], ys[2], ys[3], ys[1]] + ys[4:])


def test_ledger_ids_live_in_keyed_state(spark, sf_dir):
    base = tempfile.mkdtemp(prefix="ledger-")
    src, led, ck = (os.path.join(base, d) for d in ("in", "ledger", "ck"))
    snap, ven = T.inventory_snapshot(spark, sf_dir), T.vendors(spark, sf_dir)
    docs, paths = _files(spark, sf_dir, src)
    _touch_in_order(paths)
    ledger.init_ledger(snap, led)

    def run(keep=3):
        q = ledger.start_ledger(spark, src + "/*", ven, led, ck, max_files_per_trigger=1, keep=keep)
        q.awaitTermination()
        return q
    state = run().lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] == docs.select("order_id").distinct().count()
    assert "rocksdbBytesCopied" in state["customMetrics"] or any("rocksdb" in k for k in state["customMetrics"])
    cols = ["store_id", "product_id", "current_stock", "total_units_received"]
    before = sorted(ledger.current_snapshot(spark, led).select(*cols).collect())
    # versions beyond the last ones are gone; neither they nor the log of ids is needed to find repeats
    assert len(ledger.partition_values(spark, led, "v")) <= 5
    assert ledger.remove_folder(spark, led + "_applied")
    for i in (0, 5):
        spark.read.parquet(paths[i]).coalesce(1).write.parquet(os.path.join(src, f"repeat{i}"))
    progress = run().lastProgress
    assert progress["stateOperators"][0]["numRowsTotal"] == state["numRowsTotal"]
    assert sorted(ledger.current_snapshot(spark, led).select(*cols).collect()) == before


def test_replayed_batch_writes_the_same_version(spark, sf_dir):
    base = tempfile.mkdtemp(prefix="ledger-")
    led = os.path.join(base, "ledger")
    snap, ven = T.inventory_snapshot(spark, sf_dir), T.vendors(spark, sf_dir)
    ledger.init_ledger(snap, led)
    orders = T.orders_nested(spark, sf_dir)
    cols = ["store_id", "product_id", "current_stock"]
    apply = ledger._apply_batch(ven, led, 10)
    apply(orders, 0)
    once = sorted(ledger.current_snapshot(spark, led).select(*cols).collect())
    apply(orders, 0)
    assert sorted(ledger.current_snapshot(spark, led).select(*cols).collect()) == once
    assert once != sorted(snap.select(*cols).collect())


def _frame(df, key=("store_id", "product_id", "as_of_date")):
    return df.toPandas().sort_values(list(key)).reset_index(drop=True)


def test_batches_prune_to_their_buckets_and_compaction_changes_nothing(spark, sf_dir):
    base = tempfile.mkdtemp(prefix="ingest-")
    src, store, ck = (os.path.join(base, d) for d in ("in", "state", "ck"))
    retail, snap = T.retail_daily(spark, sf_dir).cache(), T.inventory_snapshot(spark, sf_dir)
    years = [r[0] for r in retail.select(F.year("date").alias("y")).distinct().orderBy("y").collect()][:5]
    used = retail.filter(F.year("date").isin(years))

    def deliver(ys):
        for y in ys:
            retail.filter(F.year("date") == y).write.parquet(os.path.join(src, f"y{y}"))
        q = ingest.start_ingest(spark, src + "/*", snap, store, ck, schema=retail.schema, buckets=8)
        q.awaitTermination()
    deliver(years[:1])
    deliver(years[2:3])
    deliver(years[1:2])                              # a late year: its series are rewound, earlier rows superseded
    before = _frame(ingest.read_features(spark, store, snap))
    assert ingest._later(spark, store, "epoch", None, None).count() > 0
    rows = ingest.rows_of(spark, store, "hist").count()
    stored = spark.read.parquet(os.path.join(store, "hist")).count()
    g = ingest.compact(spark, store, ck)
    assert g == 2 and ingest.compact(spark, store, ck) is None       # nothing new to fold
    pd_equal(_frame(ingest.read_features(spark, store, snap)), before)
    folded = spark.read.parquet(os.path.join(store, "compacted", f"g={g}", "hist"))
    assert folded.count() == rows < stored

    # the scan of a batch is pruned to the buckets of its series
    bucket = [3]
    one = ingest.rows_of(spark, store, "hist", buckets=bucket)
    plan = one._jdf.queryExecution().toString().replace("isnotnull(", "")
    assert "PartitionFilters: [bucket#" in plan
    everything = ingest.rows_of(spark, store, "hist")
    size = lambda fs: sum(os.path.getsize(f.removeprefix("file:").replace("%20", " ").replace("///", "/")) for f in fs)
    share = one.count() / everything.count()
    read = [f for f in folded.inputFiles() if "bucket=3" in f]
    assert read and abs(size(read) / size(folded.inputFiles()) - share) < 0.1
    assert one.select("store_id", "product_id").distinct().count() == everything.select("store_id", "product_id").distinct() \
        .filter(ingest.bucket_of(8) == 3).count()

    # a batch that is replayed reads the generation before it; removing what was folded changes nothing
    assert ingest.generation(spark, store, before=2) is None and ingest.generation(spark, store, before=3) == 2
    deliver(years[3:4])
    deliver(years[4:])
    got = ingest.read_features(spark, store, snap)
    exp = _frame(FE.features_v2(used, snap, include_created_at=False))
    pd_equal(_frame(got)[exp.columns], exp)
    assert ingest.compact(spark, store, ck, remove=True) == 4
    assert ingest.partition_values(spark, os.path.join(store, "hist"), "batch_id") == []
    assert ingest.partition_values(spark, os.path.join(store, "compacted", "done"), "g") == [4]
    pd_equal(_frame(ingest.read_features(spark, store, snap))[exp.columns], exp)


def pd_equal(a, b):
    num = [c for c in b.columns if b[c].dtype.kind in "fi"]
    rest = [c for c in b.columns if c not in num]
    assert len(a) == len(b) and (a[num] - b[num]).abs().max().max() < 1e-9 and (a[rest] == b[rest]).all().all()

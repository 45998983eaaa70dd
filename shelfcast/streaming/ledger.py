"""Order intake -> stock ledger as a Structured Streaming job.

Input: a stream of order documents (order_id, store_id, created_at, items
array<struct<product_id, quantity>>), one row per whole order, so an order
is accepted or rejected atomically inside one micro-batch.  No order is too
late: repeats are found by id, not by event time.

Keyed state: the ids ever seen are the state of a streaming ``dropDuplicates`` on
``order_id`` without a watermark, kept by the RocksDB provider.  A batch looks
up and adds its own ids only, and its checkpoint is a change log, so neither
grows with the number of orders handled before.  Of orders that share an id the
first delivered one counts.

Versions of the snapshot lie under ``<ledger>/v=<batch>``.  Batch ``b`` reads
version ``b - 1``, applies the accepted receipts (X03) and overwrites ``v=b``; rejects
go to ``<ledger>_rejects/batch=<b>``, the ids it handled to
``<ledger>_applied/batch=<b>`` (a log; the stream never reads it).  Versions
older than the last ``keep`` are removed.  A batch that is replayed after a
failure starts from the state and the version before it and writes the same
again: the sink is idempotent by batch id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfcast.functions.joins import partitions_for
from shelfcast.operators import orders as OR
from shelfcast.session import cut_lineage
from shelfcast.sources.readers import folder_exists, partition_values, remove_folder

ORDER_DOC_SCHEMA = ("order_id long, store_id string, created_at timestamp, "
                    "items array<struct<product_id:string,quantity:bigint>>")


STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def init_ledger(snapshot: DataFrame, ledger: str) -> None:
    """Version -1: the starting snapshot."""
    snapshot.withColumn("v", F.lit(-1).cast("long")).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("v").parquet(ledger)


def current_snapshot(spark: SparkSession, ledger: str, before: int | None = None) -> DataFrame:
    """The newest committed version (below ``before`` when given)."""
    newest = max(v for v in partition_values(spark, ledger, "v") if before is None or v < before)
    return spark.read.parquet(f"{ledger}/v={newest}")


def previous_version(spark: SparkSession, ledger: str, batch_id: int) -> int:
    """The version a batch starts from: the one before it, or, where its checkpoint is newer than the ledger, the newest below."""
    if folder_exists(spark, f"{ledger}/v={batch_id - 1}"):
        return batch_id - 1
    return max(v for v in partition_values(spark, ledger, "v") if v < batch_id)


def _apply_batch(vendors: DataFrame, ledger: str, keep: int):
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        snap = spark.read.parquet(f"{ledger}/v={previous_version(spark, ledger, batch_id)}")
        orders = cut_lineage(batch)  # the state is looked up once
        lines = orders.select("order_id", "store_id", F.explode("items").alias("i")).select(
            "order_id", "store_id", "i.product_id", "i.quantity")
        ev = OR.evaluate_orders(lines, snap, vendors, partitions_for(spark, lines.count()))
        new = OR.apply_receipts(snap, OR.priced_of(ev))
        OR.rejects_of(ev).write.mode("overwrite").parquet(f"{ledger}_rejects/batch={batch_id}")
        orders.select("order_id").write.mode("overwrite").parquet(f"{ledger}_applied/batch={batch_id}")
        new.write.mode("overwrite").parquet(f"{ledger}/v={batch_id}")
        # one version leaves per batch: no listing of all versions
        remove_folder(spark, f"{ledger}/v={batch_id - keep}")
    return run


def start_ledger(spark: SparkSession, orders_dir: str, vendors: DataFrame, ledger: str, checkpoint: str,
                 available_now: bool = True, max_files_per_trigger: int | None = None, keep: int = 10) -> StreamingQuery:
    # read at the start of the query; a restarted query keeps the provider of its checkpoint
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    r = spark.readStream.schema(ORDER_DOC_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    once = r.parquet(orders_dir).dropDuplicates(["order_id"])
    w = once.writeStream.foreachBatch(_apply_batch(vendors, ledger, max(2, keep))).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()

"""Queries: the two streams replayed over data derived from the test tables.

Each query writes its source files (one set per year) into a fresh folder
under the shared checkpoint folder, runs the stream to completion
(``Trigger.AvailableNow``, one file set per micro-batch) and returns the state
the stream maintains.  A stream is correct when that state equals the batch
answer, so the batch oracles apply: the ledger's final snapshot is
``stock_after_orders``; the incrementally maintained features are
``features_v2``.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from shelfcast.plans.catalog import register
from shelfcast.plans.q_orders import osql
from shelfcast.plans import oracle_features as O
from shelfcast.session import scratch_path
from shelfcast.sources import testdata as T
from shelfcast.sources.readers import partition_values
from shelfcast.streaming import ingest, ledger

STOCK_AFTER_SQL = osql("""SELECT s.store_id, s.product_id, s.category, s.region,
  s.current_stock + COALESCE(a.q, 0) AS current_stock, s.total_units_sold,
  s.total_units_received + COALESCE(a.q, 0) AS total_units_received, s.lead_time_days
FROM inventory_snapshot s LEFT JOIN (SELECT store_id, product_id, CAST(SUM(quantity) AS BIGINT) AS q FROM priced
  GROUP BY 1, 2) a ON a.store_id = s.store_id AND a.product_id = s.product_id""", "priced")


def _write_by_year(df, col, base):
    """A folder per year, oldest first (the file source takes files by age); the table is made once."""
    staged = os.path.join(base, "staged")
    df.withColumn("_y", F.year(col)).repartition("_y").write.partitionBy("_y").parquet(staged)
    years = partition_values(df.sparkSession, staged, "_y")
    for i, y in enumerate(years):
        df.sparkSession.read.schema(df.schema).parquet(f"{staged}/_y={y}").write.parquet(os.path.join(base, "in", f"f{i:04d}"))
    return len(years)


@register("order_ledger_stream", STOCK_AFTER_SQL)
def q_order_ledger_stream(spark, sf_dir):
    """Order documents (four files a year, in any order) streamed into the stock ledger; the final snapshot."""
    base = scratch_path(spark, f"ledger-{uuid.uuid4().hex}")
    # one job: each of four tasks writes a file per year
    T.orders_nested(spark, sf_dir).withColumn("y", F.year("created_at")).repartition(4) \
        .write.partitionBy("y").parquet(os.path.join(base, "in"))
    led = os.path.join(base, "ledger")
    ledger.init_ledger(T.inventory_snapshot(spark, sf_dir), led)
    q = ledger.start_ledger(spark, os.path.join(base, "in", "*"), T.vendors(spark, sf_dir), led,
                            os.path.join(base, "ck"), max_files_per_trigger=4)
    q.awaitTermination()
    return ledger.current_snapshot(spark, led)


@register("incremental_features_stream", O.features_v2_sql(1))
def q_incremental_features_stream(spark, sf_dir):
    """Daily rows streamed year by year; the incrementally maintained v2 features."""
    base = scratch_path(spark, f"ingest-{uuid.uuid4().hex}")
    retail = T.retail_daily(spark, sf_dir)
    snap = T.inventory_snapshot(spark, sf_dir)
    _write_by_year(retail, "date", base)
    q = ingest.start_ingest(spark, os.path.join(base, "in", "*"), snap, os.path.join(base, "state"),
                            os.path.join(base, "ck"), max_files_per_trigger=1, schema=retail.schema)
    q.awaitTermination()
    return ingest.read_features(spark, os.path.join(base, "state"), snap)

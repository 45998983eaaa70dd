"""Sinks (S05-S09): parquet/json/csv writers with explicit layouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_RECORDS_PER_FILE = 5_000_000


def write_features(df: DataFrame, path: str, partition_col: str = "store_id") -> None:
    """Overwrite the feature table, partitioned by store.

    No repartition by store (a store holding a third of the rows would land
    in one task): each task sorts its rows by the partition column so it keeps
    one open file at a time, and files are capped in size.
    """
    (df.sortWithinPartitions(partition_col).write.mode("overwrite")
       .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy(partition_col).parquet(path))


SERIES = ("store_id", "product_id")


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, order: str = "as_of_date", keys: Sequence[str] = SERIES) -> None:
    """S05/S06 for tables that are read often: bucketed by series and sorted, one file per bucket.

    Windows, groupings and joins by series over the table then need no exchange.  ``buckets`` is chosen once, for
    about 200 MB a bucket.  A series is one row a day, so no bucket is hot, whatever a store's share.
    """
    (df.repartition(buckets, *keys).sortWithinPartitions(*keys, order).write.mode("overwrite")
       .bucketBy(buckets, *keys).sortBy(*keys, order).option("path", path).saveAsTable(table))


def open_bucketed(spark: SparkSession, table: str, path: str, schema: str, buckets: int, order: str = "as_of_date",
                  keys: Sequence[str] = SERIES) -> DataFrame:
    """A table that another session wrote with :func:`write_bucketed`, registered here under ``table``."""
    names = ", ".join(keys)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING parquet CLUSTERED BY ({names}) "
              f"SORTED BY ({names}, {order}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def write_splits(df: DataFrame, path: str) -> None:
    """The three splits in one write, partitioned by ``split``."""
    (df.sortWithinPartitions("split").write.mode("overwrite")
       .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy("split").parquet(path))


def write_run_copy(df: DataFrame, base: str, run_id: str) -> None:
    """A raw copy under ``run_id=<id>`` (other runs untouched: dynamic overwrite)."""
    (df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(base))


def append_table(df: DataFrame, path: str, replace: bool = False) -> None:
    """Append (or replace) a table; batching is the writer's."""
    df.write.mode("overwrite" if replace else "append").parquet(path)


def write_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Report frames as JSON or CSV, written by the tasks that hold the rows (some reports have a row per series)."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.json(path)

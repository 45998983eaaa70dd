"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: AQE re-plans joins and coalesces/splits
# partitions at runtime, UTC keeps dates stable across machines, and the UI
# stays off (no HTTP server).
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    # checkpoint files of frames that are no longer referenced are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "shelfcast", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's base settings."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared folder and is used as is.  Only
    when it is unset and the master is local (tests) a scratch folder is made.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="shelfcast-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as Parquet in the shared checkpoint folder and read it back.

    Survives executor loss: the data sits in the shared folder, not in
    executor memory or local disk.  Readers prune columns and push filters down
    into it, which an RDD checkpoint does not allow.
    """
    spark = df.sparkSession
    path, schema = staged_path(spark, f"stage-{uuid.uuid4().hex}"), df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


_OPEN: list[list[str]] = []  # staged folders of the scopes that are open in this driver, innermost last


def staged_path(spark: SparkSession, name: str) -> str:
    """A folder for an intermediate table; it belongs to the innermost open :func:`released` scope, if there is one."""
    path = scratch_path(spark, name)
    if _OPEN:
        _OPEN[-1].append(path)
    return path


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Scope of a job: intermediate tables staged inside are removed at its end, also when it fails.

    What leaves the scope must be written (or collected) before: a frame that still reads a staged table cannot be
    used afterwards.  Scopes nest; one driver thread at a time stages into a scope.
    """
    _OPEN.append([])
    try:
        yield
    finally:
        jvm = spark.sparkContext._jvm
        for path in _OPEN.pop():
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)

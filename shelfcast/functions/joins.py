"""Join helpers with explicit size reasoning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Default bound for broadcasting a dimension-like frame (rows).  Beyond it the
# join stays a shuffle join (AQE may still pick broadcast from runtime size).
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20
# Rows of one shuffle partition where whole rows are sorted and grouped: a task then holds some 150 MB at a time.
ROWS_PER_PARTITION = 200_000
# estimated bytes of a value; strings and nested values count as 64
_WIDTH = {"boolean": 8, "byte": 8, "short": 8, "integer": 8, "long": 8, "float": 8, "double": 8, "date": 8, "timestamp": 8}


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame (a global aggregate) to every row.

    The row becomes one uncorrelated scalar subquery (``DataFrame.scalar``)
    holding a struct of all its columns: Spark runs the aggregate once and
    uses the value as a constant in the main plan, so no join of any kind is
    planned and the main plan stays in whole-stage codegen.  The subquery
    appears once in the plan (fields are read from one column), which keeps
    nested uses from multiplying plan size.
    """
    cols = one_row.columns
    att = "__attached"
    s = one_row.select(F.struct(*[F.col(c) for c in cols]).alias(att)).scalar()
    return (df.withColumn(att, s)
              .withColumns({c: F.col(att)[c] for c in cols})
              .drop(att))


def bounded_broadcast(small: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``small`` only after checking it has at most ``max_rows`` rows.

    The frame is first materialised with a reliable ``checkpoint`` into the
    shared checkpoint folder (``spark.checkpoint.dir``), so the size check and
    the join read it once, it survives executor loss, and — unlike a cached
    frame, which Spark matches by plan — a later run over changed input files
    cannot pick up stale rows.  Above the bound in rows, or in estimated bytes (rows times the
    width of the columns), the join stays a shuffle join.
    """
    from shelfcast.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(small.sparkSession)
    small = small.checkpoint(eager=True)
    n = small.limit(max_rows + 1).count()
    width = sum(_WIDTH.get(f.dataType.typeName(), 64) for f in small.schema.fields)
    return F.broadcast(small) if n <= max_rows and n * width <= MAX_BROADCAST_BYTES else small


def partitions_for(spark: SparkSession, rows: int, per_partition: int = ROWS_PER_PARTITION) -> int | None:
    """Number of shuffle partitions for ``rows``; None where the session's number is enough.

    A shuffle takes the session's fixed number of partitions, and AQE only merges
    those of a grouping, so what a task sorts and groups would grow with the input.
    """
    n = -(-rows // per_partition)
    return n if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def join_small(big: DataFrame, small: DataFrame, on: Sequence[str] | str, how: str = "left",
               max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    return big.join(bounded_broadcast(small, max_rows), on, how)

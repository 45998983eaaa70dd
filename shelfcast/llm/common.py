"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.session import staged_path

# ASCII white space as the text contracts define it: \x20 and \x09-\x0D.
WS = r"[\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable for the Python workers of all executors (once per application).

    Spark itself carries the archive from the driver to the executors, so no
    worker needs the repository on its path.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="shelfcast-code-")) / "shelfcast-code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


def shared_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder name under ``spark.checkpoint.dir`` (shared by all executors), removed with its ``released`` scope."""
    return staged_path(spark, f"shelfcast-llm/{tag}-{uuid.uuid4().hex}")


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation,
    and every later use sees the same rows.
    """
    spark = df.sparkSession
    path = shared_path(spark, tag)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash (case-insensitively) with those of ``df``."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n = "_" + n
        have.add(n.lower())
        out.append(n)
    return out


def without(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Columns of ``df`` except those a result column replaces (case-insensitive)."""
    gone = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in gone]


def quoted(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def add_columns(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """``df`` plus result columns; an input column of the same name is replaced."""
    keep = without(df, list(values))
    return df.select(*[quoted(c) for c in keep], *[v.alias(k) for k, v in values.items()])


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once: higher-order functions re-evaluate what a lambda names."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text (not null), in order."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WS))


def text_key(text: Column) -> Column:
    """64-bit digest of a text; with the document's id it names a row.

    Rows that agree in id and text are one document to the operators: each of
    them gets the same result.
    """
    return F.xxhash64(F.coalesce(text, F.lit("")))


def join_by_key(left: DataFrame, right: DataFrame, keys: Sequence[str], spread: Sequence[str],
                count: str, total: int, hot: int = 1000, salts: int = 64) -> DataFrame:
    """Left join of many rows to one row per key, safe when one key holds most rows.

    ``right`` has one row for each value of ``keys`` (never null) and, in
    ``count``, how many rows of ``left`` carry it; ``total`` is the sum of these
    counts.  Keys with more than ``total / hot`` rows are at most ``hot`` keys,
    whatever the data: this bounded part is broadcast.  All other rows meet in
    a shuffle join in which no key has more than ``total / hot`` rows.  Rows
    that the broadcast part has served carry a salt (from the ``spread``
    columns), match nothing there and are dealt evenly.
    """
    values = [c for c in right.columns if c not in keys]
    hit, salt = fresh(left.join(right, list(keys)), "_hot", "_salt")
    is_hot = F.col(count) * hot > F.lit(int(total))
    few = right.where(is_hot).select(*keys, F.struct(*values).alias(hit))
    rest = right.where(~is_hot).select(*keys, F.lit(0).alias(salt), F.struct(*values).alias("_cold_" + hit))
    out = left.join(F.broadcast(few), list(keys), "left")
    out = out.withColumn(salt, F.when(F.col(hit).isNull(), F.lit(0)).otherwise(
        F.lit(1) + F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")))
    out = out.join(rest, [*keys, salt], "left")
    return out.select(*[quoted(c) for c in left.columns],
                      *[F.coalesce(F.col(hit)[v], F.col("_cold_" + hit)[v]).alias(v) for v in values])


def has_rows(df: DataFrame) -> bool:
    return df.limit(1).count() > 0


def in_training(doc_id: Column, modulus: int, held_out: int) -> Column:
    """Learn from rows whose crc32(id as text) mod ``modulus`` is not ``held_out`` (null id: '')."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus)) != held_out

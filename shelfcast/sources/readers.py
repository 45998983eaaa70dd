"""Sources (S01-S04, S10, S11).

Readers take an explicit schema (no inference) and return snake_case
columns; the source application's display names (``Store ID``) are mapped
at the boundary.  Change detection compares a cheap (count, max date)
fingerprint — one aggregate that parquet footers can answer — with the one
stored by the previous run.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast import config as C

RETAIL_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()), T.StructField("store_id", T.StringType()),
    T.StructField("product_id", T.StringType()), T.StructField("category", T.StringType()),
    T.StructField("region", T.StringType()), T.StructField("inventory_level", T.LongType()),
    T.StructField("units_sold", T.LongType()), T.StructField("units_ordered", T.LongType()),
    T.StructField("demand_forecast", T.DoubleType()), T.StructField("price", T.DoubleType()),
    T.StructField("discount", T.DoubleType()), T.StructField("weather_condition", T.StringType()),
    T.StructField("holiday_promotion", T.IntegerType()), T.StructField("competitor_pricing", T.DoubleType()),
    T.StructField("seasonality", T.StringType()),
])

SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("store_id", T.StringType()), T.StructField("product_id", T.StringType()),
    T.StructField("category", T.StringType()), T.StructField("region", T.StringType()),
    T.StructField("current_stock", T.LongType()), T.StructField("total_units_sold", T.LongType()),
    T.StructField("total_units_received", T.LongType()), T.StructField("lead_time_days", T.LongType()),
])


def normalise_columns(df: DataFrame) -> DataFrame:
    """F19 + display-name mapping: strip header blanks, map to snake_case."""
    out = df.toDF(*[c.strip() for c in df.columns])
    return out.toDF(*[C.DISPLAY_NAMES.get(c, c) for c in out.columns])


INGEST = "_ingest"


def _with_ingest_order(raw: DataFrame) -> DataFrame:
    """``_ingest``: the place of each row in its source (file, block, running number in the block)."""
    m = F.col("_metadata")
    return raw.select("*", F.struct(m["file_path"].alias("file"), m["file_block_start"].alias("block"),
                                    F.monotonically_increasing_id().alias("row")).alias(INGEST))


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    df = normalise_columns(df)
    cols = [F.col(INGEST)] if INGEST in df.columns else []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
               require_rows: bool = True, ingest_order: bool = False) -> DataFrame:
    """Read a stored table, conform names and types; error if it is empty.

    ``ingest_order`` (file formats) adds ``_ingest``, which orders rows as the source holds them.
    """
    if fmt == "parquet":
        raw = spark.read.parquet(path)
    elif fmt == "csv":
        raw = read_csv(spark, path)
    elif fmt == "json":
        raw = read_json(spark, path)
    else:
        raw = spark.read.format(fmt).load(path)   # e.g. a document-store connector
    if ingest_order:
        raw = _with_ingest_order(raw)
    df = _conform(raw, schema)
    if require_rows and df.isEmpty():
        raise ValueError(f"source {path} is empty or does not exist")
    return df


def read_retail(spark: SparkSession, path: str, fmt: str = "parquet", ingest_order: bool = False) -> DataFrame:
    return read_table(spark, path, RETAIL_SCHEMA, fmt, ingest_order=ingest_order)


def read_snapshot(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, path, SNAPSHOT_SCHEMA, fmt)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with header; empty fields are null (never NaN)."""
    r = spark.read.option("header", True).option("nullValue", "").option("nanValue", "NaN-not-used")
    if schema is not None:
        return r.schema(schema).csv(path)
    # header names are needed before the schema can be applied: read as strings
    return r.option("inferSchema", False).csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """What a JSON file means depends on that file alone.

    A top-level array gives one row per element.  An object gives the elements
    of its first list field (in document order, of any element type); an object
    without a list is a single document.  ``schema`` describes one row.  Without it
    the elements are taken as VARIANT: if all are objects, their common schema becomes
    the columns; else (scalars, lists, or a mixture, objects among them) nothing is
    lost either: all come back in one string column ``value``, scalars as text, the others as
    JSON.  With a ``schema`` an element that is no object is an error.  A file is read as a
    whole, so it must fit into a task.
    """
    files = spark.read.option("wholetext", True).text(path).select(F.trim(F.regexp_replace("value", r"^\s+|\s+$", "")).alias("j"))
    lists = F.filter(F.json_object_keys("j"), lambda k: F.substring(_json_field(F.col("j"), k), 1, 1) == "[")
    kind = F.substring("j", 1, 1)
    body = (F.when(kind == "[", F.col("j"))
             .when((kind == "{") & (F.size(lists) > 0), _json_field(F.col("j"), F.get(lists, F.lit(0))))
             .when(kind == "{", F.concat(F.lit("["), F.col("j"), F.lit("]"))))
    parsed = files.select(body.alias("b"), F.from_json(body, "array<string>").alias("e"))
    if parsed.filter(F.col("e").isNull()).limit(1).count():
        raise ValueError("JSON file must contain an array or object at the top level.")
    rows = parsed.select(F.explode("e").alias("value"))
    other = rows.filter(~F.coalesce(F.substring("value", 1, 1) == "{", F.lit(False))).limit(1).count() > 0
    if schema is not None:
        if other:
            raise ValueError("an element that is not an object has no columns: read the file without a schema")
        return rows.select(F.from_json("value", schema).alias("r")).select("r.*")
    if other:
        return rows
    elements = rows.select(F.parse_json("value").alias("v"))
    found = elements.agg(F.schema_of_variant_agg("v")).first()[0]
    return elements.select(F.variant_get("v", "$", struct_type(found)).alias("r")).select("r.*")


def struct_type(found: str) -> str:
    """Column types for a schema of VARIANTs: objects are structs, fractions doubles, what is null or mixed a string (JSON text)."""
    parts = re.split(r"(`(?:[^`]|``)*`)", found)  # quoted names stay as they are
    for i in range(0, len(parts), 2):
        p = re.sub(r"\bOBJECT<", "STRUCT<", parts[i])
        p = re.sub(r"\bDECIMAL\(\d+,\s*0\)(?!\s*:)", "DECIMAL(38,0)", p)
        p = re.sub(r"\bDECIMAL\(\d+,\s*[1-9]\d*\)(?!\s*:)", "DOUBLE", p)
        parts[i] = re.sub(r"\b(VOID|VARIANT)\b(?!\s*:)", "STRING", p)
    return "".join(parts)


def _json_field(doc, key):
    """JSON text of a top-level field whose name is itself a column."""
    return F.call_function("get_json_object", doc, F.concat(F.lit("$['"), key, F.lit("']")))


def fingerprint(df: DataFrame, date_col: str = "date") -> DataFrame:
    """(row count, max date) in one aggregate."""
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.max(F.col(date_col)).cast("string").alias("max_date"))


def fingerprint_changed(current: DataFrame, last: DataFrame | None) -> DataFrame:
    """S11 decision: one row (changed, count, max_date) comparing two fingerprints."""
    if last is None:
        return current.withColumn("changed", F.lit(True))
    l2 = last.select(F.col("row_count").alias("_lc"), F.col("max_date").alias("_lm"))
    from shelfcast.functions.joins import attach_row
    j = attach_row(current, l2)
    return j.select("row_count", "max_date",
                    (~(F.col("row_count").eqNullSafe(F.col("_lc"))
                       & F.col("max_date").eqNullSafe(F.col("_lm")))).alias("changed"))


def extract_if_changed(df: DataFrame, base: str, run_id: str, date_col: str = "date") -> tuple[DataFrame, bool]:
    """Reuse the newest stored copy when the fingerprint is unchanged; otherwise
    write a run copy (S07) and only then the new fingerprint (so a crash between
    the two re-pulls next time instead of trusting a partial copy)."""
    spark = df.sparkSession
    fp_path, data_path = os.path.join(base, "_fingerprint"), os.path.join(base, "runs")
    cur = fingerprint(df, date_col)
    last = spark.read.parquet(fp_path) if folder_exists(spark, fp_path) else None
    changed = fingerprint_changed(cur, last).first()["changed"]
    if not changed and folder_exists(spark, data_path):
        runs = spark.read.parquet(data_path)
        newest = runs.agg(F.max("run_id")).first()[0]
        if newest is not None:
            return runs.filter(F.col("run_id") == newest).drop("run_id"), False
    from shelfcast.sources.writers import write_run_copy
    write_run_copy(df, data_path, run_id)
    cur.write.mode("overwrite").parquet(fp_path)
    return spark.read.parquet(data_path).filter(F.col("run_id") == run_id).drop("run_id"), True


def partition_values(spark: SparkSession, base: str, col: str) -> list[int]:
    """Values of an integer partition column, from the folder names under ``base`` (none: no such folder)."""
    if not folder_exists(spark, base):
        return []
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[len(col) + 1:]) for n in names if n.startswith(col + "="))


def folder_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Remove a folder that this engine wrote, with all in it; False if there is none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

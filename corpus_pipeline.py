"""Corpus pipeline over ``documents``: quality, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns a DataFrame that is written as Parquet and reread as the next
stage's ``docs``.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import stage
from shelfcast.llm.decontamination import decontaminate
from shelfcast.llm.line_dedup import line_dedup
from shelfcast.llm.packing import pack
from shelfcast.llm.quality_rules import quality_rules
from shelfcast.llm.queries import tokenizer_path
from shelfcast.llm.simhash import simhash_dedup


def _with_text(docs: DataFrame, result: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs`` with a stage's text; ``n_chars`` follows it."""
    new = {"text": F.col(text)} | ({"n_chars": F.length(text).cast("long")} if "n_chars" in docs.columns else {})
    return result.withColumns(new).select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: rejected documents go, kept ones lose their failing lines.

    Null, empty and blank texts are rejected; an empty table stays empty.  Repeated rows are judged alike; null ids stay.
    """
    return _with_text(docs, quality_rules(docs).where("kept"), "clean_text")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: later occurrences of three-line windows go; a document left without a word goes too.

    So null, empty and blank texts go.  Rows equal in id and text are one document and keep the same lines; a null id
    ranks last.  Texts of fewer than three lines with words stay as they are.
    """
    out = _with_text(docs, line_dedup(docs), "text")
    return out.where(F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one document of each SimHash component stays (3-word shingles, 2 bits): the one with the smallest id.

    Texts without a word share fingerprint zero, so one of them stays; of rows that tie in id, one stays.
    """
    return simhash_dedup(docs, shingle=3, radius=2).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that hold a window of a benchmark item go.

    Null and empty texts hold none and stay; with an empty benchmark all stay.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, benchmark).where(~F.col("contaminated")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: pieces of at most 4096 tokens and their places in sequences.

    A null or empty text is one piece, the end id; an empty table gives an empty table.  Only pieces come out, no other column.
    """
    return pack(docs, tokenizer_path(), capacity=4096, end_id=1)


STAGES = [("quality rules", quality), ("line dedup", lines), ("simhash near-dedup", near_duplicates),
          ("benchmark decontamination", decontamination), ("best-fit packing", packing)]
ORACLE_SQL = None  # SimHash fingerprints (XXH64) have no SQL form; tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, fn in STAGES[:-1]:
        docs = stage(fn(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

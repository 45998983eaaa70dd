"""Substring dedup by line or paragraph hashing (operator 9).

A text is cut into units (lines, or paragraphs at blank lines).  Every unit that
holds a word is normalised (lower case, runs of white space to one blank) and
grouped by a 128-bit digest over the whole corpus, however short it is.  Each
group has an earliest occurrence, ranked by ``doc_id``, text digest and position;
the others are *repeats*.

What goes is a repeated *passage*: a run of adjacent repeats (units without a word
between them do not end it) that together have at least ``min_run_words`` words.
A heading, a set phrase or a short list entry that many documents share is a
repeat too, but alone it is no passage and stays; the same line inside a longer
repeated stretch goes with it.  ``min_run_words=1`` cuts every repeat.  The first
occurrence of each unit always stays.  Units without a word always stay.
``spans`` retains where the cut units stood: offsets (code points from 0) and
lengths in the original text.

Only digests, ids, positions and word counts are shuffled for grouping; a digest that
holds a large part of all rows goes through the bounded part of
:func:`~shelfcast.llm.common.join_by_key`.  Runs are found per document over its
repeats, on the partitioning that brings them together.

Defined results: a null text stays null with no spans, an empty one stays
empty.  A null ``doc_id`` ranks after all others.  Rows equal in id and text are
one document and get the same result.  Extra columns pass through; an input
column named like a result column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import add_columns, bind, fresh, join_by_key, quoted, stage, text_key, words_of

BLOCK = 256
SEPARATOR = {"line": "\n", "paragraph": "\n\n"}
RESULT = ["text", "n_units", "n_removed", "spans"]
MIN_RUN_WORDS = 15   # words that make a run of repeated units a passage: about a sentence


def units(docs: DataFrame, id_col: str, text_col: str, unit: str) -> DataFrame:
    """One row per unit with a word: digest (h1, h2), document (d, t), unit number (u), its number among these (w), words (k)."""
    text = quoted(text_col)
    parts = F.transform(F.split(text, SEPARATOR[unit]), lambda x, i: F.struct(words_of(x).alias("w"), i.alias("u")))
    worded = F.transform(F.filter(parts, lambda s: F.size(s["w"]) > 0), lambda s, i: F.struct(
        F.lower(F.array_join(s["w"], " ")).alias("x"), s["u"].alias("u"), i.alias("w"), F.size(s["w"]).alias("k")))
    df = docs.where(text.isNotNull()).select(quoted(id_col).alias("d"), text_key(text).alias("t"), F.explode(worded).alias("s"))
    df = df.select("d", "t", "s.u", "s.w", "s.k", "s.x")
    return df.select(F.xxhash64("x").alias("h1"), F.xxhash64(F.lit("u"), "x").alias("h2"), "d", "t", "u", "w", "k")


def runs(repeats: DataFrame, min_run_words: int) -> DataFrame:
    """(d, t, gone): the units of each document that stand in long enough runs of adjacent repeats."""
    per_document = repeats.groupBy("d", "t").agg(F.array_sort(F.collect_set(F.struct("w", "u", "k"))).alias("r"))
    # in ascending order, number less position is the same within a run and differs between runs
    marked = per_document.select("d", "t", F.explode(F.transform("r", lambda s, i: F.struct(
        (s["w"] - i).alias("run"), s["u"].alias("u"), s["k"].alias("k")))).alias("s")).select("d", "t", "s.run", "s.u", "s.k")
    long = marked.groupBy("d", "t", "run").agg(F.sum("k").alias("words"), F.collect_list("u").alias("us"))
    return long.where(F.col("words") >= min_run_words).groupBy("d", "t").agg(
        F.array_sort(F.flatten(F.collect_list("us"))).alias("gone"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def block_sums(n: Column) -> Column:
    """Sums of blocks of ``BLOCK`` lengths."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(n) - 1) / BLOCK).cast("int")),
                       lambda b: _sum(F.slice(n, b * BLOCK + 1, F.lit(BLOCK))))


def running(n: Column, sums: Column, i: Column) -> Column:
    """Sum of the first ``i`` lengths: whole blocks, then the rest of a block."""
    whole = F.floor(i / BLOCK).cast("int")
    return _sum(F.slice(sums, F.lit(1), whole)) + _sum(F.slice(n, whole * BLOCK + 1, i - whole * BLOCK))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "line",
                    min_run_words: int = MIN_RUN_WORDS) -> DataFrame:
    """``docs`` with repeated passages cut from ``text``; ``n_units``, ``n_removed`` and ``spans`` describe the cuts."""
    d, t, g = fresh(docs, "_d", "_t", "_gone")
    many = stage(units(docs, id_col, text_col, unit), "units")
    rank = F.struct(F.col("d").isNull().alias("z"), F.col("d").alias("d"), F.col("t").alias("t"), F.col("u").alias("u"))
    firsts = stage(many.groupBy("h1", "h2").agg(F.min(rank).alias("first"), F.max(rank).alias("last"),
                                                F.count("*").alias("n"))
                   .where(F.col("first") != F.col("last")).drop("last"), "unit-firsts")
    total = firsts.agg(F.sum("n")).first()[0] or 0
    met = join_by_key(many, firsts, ["h1", "h2"], ["d", "t", "u"], "n", total)
    repeats = met.where(F.col("first").isNotNull() & (rank != F.col("first")))
    gone = runs(repeats, min_run_words).withColumnsRenamed({"d": d, "t": t, "gone": g})
    text, sep = quoted(text_col), SEPARATOR[unit]
    met = docs.join(gone, quoted(id_col).eqNullSafe(F.col(d)) & (text_key(text) == F.col(t)), "left")
    parts = F.split(text, sep)
    left = bind(parts, lambda x: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col(g)), lambda i: F.get(x, i)))
    spans = bind(F.transform(parts, lambda x: F.length(x).cast("long") + len(sep)), lambda n: bind(
        block_sums(n), lambda sums: F.transform(g, lambda i: F.struct(
            running(n, sums, i).alias("start"), (F.get(n, i) - len(sep)).alias("length")))))
    none = F.array().cast("array<struct<start:bigint,length:bigint>>")
    cut = F.col(g).isNotNull()
    res = {text_col: F.when(cut, F.array_join(left, sep)).otherwise(text),
           "n_units": F.coalesce(F.size(parts), F.lit(0)).cast("long"),
           "n_removed": F.coalesce(F.size(g), F.lit(0)).cast("long"),
           "spans": F.when(cut, spans).otherwise(none)}
    return add_columns(met, res).drop(d, t, g)

"""Line dedup over overlapping three-line windows (operator 4).

Lines are ``\\n``-separated and compared without surrounding white space; blank
lines take no part and stay.  Every three consecutive worded lines form a
window.  A window that occurs more than once in the corpus stays at its first
occurrence (by ``doc_id``, then text digest, then position) and is removed
everywhere else; overlapping removals are merged.  A later occurrence that
overlaps the first one in the same document removes only the lines beyond it, so
the first occurrence stays whole with regard to that window.

Only digests, ids and positions are shuffled to find repeats: one aggregation
with map-side combine gives the first occurrence of each repeated window, one
skew-safe join (:func:`~shelfcast.llm.common.join_by_key`) brings it back to the
windows, and documents meet their removed positions in one join on the id.

Defined results: a null text stays null, a text with fewer than three worded
lines has no window and stays.  A null ``doc_id`` ranks after all others.  Rows
equal in id and text are one document and get the same result.  Extra columns
pass through; an input column named like a result column is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import add_columns, bind, fresh, join_by_key, quoted, stage, text_key

BLANK = " \t\n\x0b\x0c\r"
RESULT = ["text", "n_lines", "n_removed"]


def windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """One row per window: 128-bit digest (h1, h2), document (d, t), its first line's index among worded
    lines (w), and the line numbers it covers (at)."""
    text = quoted(text_col)
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x, i: F.struct(
        F.btrim(x, F.lit(BLANK)).alias("x"), i.alias("i"))), lambda s: s["x"] != "")
    digests = F.transform(lines, lambda s: F.struct(
        F.xxhash64(s["x"]).alias("a"), F.xxhash64(F.lit("b"), s["x"]).alias("b"), s["i"].alias("i")))
    df = docs.where(text.isNotNull()).select(quoted(id_col).alias("d"), text_key(text).alias("t"), digests.alias("lines"))

    def window(i):
        parts = [F.get("lines", i + j) for j in range(size)]
        return F.struct(F.xxhash64(*[p["a"] for p in parts]).alias("h1"), F.xxhash64(*[p["b"] for p in parts]).alias("h2"),
                        i.alias("w"), F.array(*[p["i"] for p in parts]).alias("at"))
    starts = F.when(F.size("lines") >= size, F.sequence(F.lit(0), F.size("lines") - size))
    many = F.explode(F.transform(starts, window))
    return df.select("d", "t", many.alias("win")).select("win.*", "d", "t")


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """(d, t, gone): the numbers of the lines to remove, merged and sorted, of each document that loses any."""
    win = stage(windows(docs, id_col, text_col, size), "line-windows")
    rank = F.struct(F.col("d").isNull().alias("z"), F.col("d").alias("d"), F.col("t").alias("t"), F.col("w").alias("w"))
    firsts = stage(win.groupBy("h1", "h2").agg(F.min(rank).alias("first"), F.max(rank).alias("last"),
                                               F.count("*").alias("n"))
                   .where(F.col("first") != F.col("last")).drop("last"), "line-firsts")
    total = firsts.agg(F.sum("n")).first()[0] or 0
    met = join_by_key(win, firsts, ["h1", "h2"], ["d", "t", "w"], "n", total)
    met = met.where(F.col("first").isNotNull() & (rank != F.col("first")))
    own = F.col("first.d").eqNullSafe(F.col("d")) & (F.col("first.t") == F.col("t"))
    # in the document of the first occurrence, its own lines stay
    at = F.filter("at", lambda x, j: ~own | (F.col("w") + j > F.col("first.w") + size - 1))
    gone = met.select("d", "t", F.explode(at).alias("line"))
    return gone.groupBy("d", "t").agg(F.array_sort(F.collect_set("line")).alias("gone"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``docs`` with ``text`` cleaned, ``n_lines`` and ``n_removed`` (lines before, lines removed)."""
    d, t, g = fresh(docs, "_d", "_t", "_gone")
    gone = removed_lines(docs, id_col, text_col, size).withColumnsRenamed({"d": d, "t": t, "gone": g})
    text = quoted(text_col)
    met = docs.join(gone, quoted(id_col).eqNullSafe(F.col(d)) & (text_key(text) == F.col(t)), "left")
    lines = F.split(text, "\n")
    left = bind(lines, lambda x: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col(g)), lambda i: F.get(x, i)))
    res = {text_col: F.when(F.col(g).isNull(), text).otherwise(F.array_join(left, "\n")),
           "n_lines": F.coalesce(F.size(lines), F.lit(0)).cast("long"),
           "n_removed": F.coalesce(F.size(g), F.lit(0)).cast("long")}
    return add_columns(met, res).drop(d, t, g)

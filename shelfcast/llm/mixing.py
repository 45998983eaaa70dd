"""Mixing sources to target weights: Sainte-Laguë quotas of equal-token blocks (operator 13).

*Targets.*  Sources in code-point order (null last) weigh 5, 2, 1, repeating.  They
share ``budget`` times all words by weight; a target stops at ``most`` times its
source's size and the excess is shared again by weight, until none is above.  With
a level L that is ``target = min(most * size, L * weight)``; each round takes the
level of the sources that are still below their bound.

*Cells.*  A source's documents are dealt to shards by a seeded hash, about
``shard_words`` words each, so a source with a third of all words is many cells and no
task ever holds a whole source.  A cell is cut into equal blocks of about
``block_words`` words.

*Quotas.*  With ``v`` the blocks a cell should give (target / size of its source,
times its blocks), the M = sum of v blocks go to the highest quotients
``v / (2k + 1)``, k = 0, 1, ...; a cell gets at most ``most`` times its blocks.  The
M-th highest quotient is found by counting: cells report, in one aggregate, how
many seats they would take at 64 levels at once, and the interval shrinks 64-fold
a round until a level gives exactly M, or only equal quotients are left; these go
by a seeded rank.

*Selection.*  Within a cell documents stand in seeded order.  A quota of q of b
blocks takes every block q div b times and q mod b blocks, those of the
smallest seeded hash, once more.  A document's ``taken`` is what its words in
these blocks add up to, so it is at most ``most`` times its size.

All choices hang on the seed, ids and texts, never on partitions or order of rows, so
reruns agree.  Cells are groups of bounded size: documents without a word skip
them, the others hold a word each at least.

Defined results: a null text, or one without words, has size 0 and takes 0; a source
of such documents alone has target 0.  A null source is a source of its own, after
all others, the empty string the first.  Rows that agree in id and text stand
side by side and are taken block by block like any others.  Null ids are allowed.  Only
the id, the text and the source are read; other columns may have any name.  An
empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import fresh, join_by_key, quoted, ship, stage

WORD = r"[^\x20\x09-\x0D]+"
WAYS = 64      # levels tried in one round of the quotient search


def _ranked(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Position (from 0) of each row in ``order``: range-sorted, numbered per task, offset by the tasks before.

    Nothing is collected but one count per task.
    """
    task, nth = fresh(df, "_task", "_nth")
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = stage(dealt.select("*", F.spark_partition_id().alias(task),
                               F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias(nth)), "ranked")
    sizes = {r[task]: r["count"] for r in dealt.groupBy(task).count().collect()}
    starts, total = [], 0
    for t in sorted(sizes):
        starts += [F.lit(t), F.lit(total)]
        total += sizes[t]
    first = F.element_at(F.create_map(*starts), F.col(task)) if starts else F.lit(0)
    return dealt.withColumn(out, (first + F.col(nth)).cast("long")).drop(task, nth)


def source_targets(sizes: DataFrame, weights: tuple[int, ...], budget: float, most: int) -> DataFrame:
    """``sizes`` (source, source_size, ...) plus its rank and ``target``."""
    ranked = _ranked(sizes, [F.col("source").isNull(), F.col("source")], "rank")
    weight = F.element_at(F.lit(list(weights)), (F.col("rank") % len(weights)).cast("int") + 1).cast("double")
    ranked = stage(ranked.select("*", weight.alias("weight"), (F.col("source_size") * most).cast("double").alias("bound")), "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        below = F.col("bound") > level * F.col("weight")
        got = ranked.agg(F.count_if(~below).alias("full"), F.sum(F.when(~below, F.col("bound")).otherwise(0.0)).alias("held"),
                         F.sum(F.when(below, F.col("weight")).otherwise(0.0)).alias("weight")).first()
        if got["full"] == full or not got["weight"]:
            break
        full, level = got["full"], (budget * total - got["held"]) / got["weight"]
    target = F.when(below, level * F.col("weight")).otherwise(F.col("bound"))
    return ranked.select(*sizes.columns, "rank", target.alias("target"))


def seats(v: Column, cap: Column, level: float) -> Column:
    """Quotients ``v / (2k + 1)``, k < cap, of at least ``1 / (2 level)``."""
    return F.least(F.floor(v * level + 0.5).cast("long"), cap)


def sainte_lague(cells: DataFrame, v: str, cap: str, total: int, tie: list[Column], out: str = "quota") -> DataFrame:
    """``cells`` plus the seats that the ``total`` highest quotients ``v / (2k + 1)`` give each; ``tie`` ranks equal ones.

    ``total`` must not be above the sum of ``cap`` over cells with ``v`` above 0.
    """
    value, bound = F.col(v), F.col(cap)

    def taken(levels: list[float]) -> list[int]:
        row = cells.agg(*[F.coalesce(F.sum(seats(value, bound, x)), F.lit(0)).alias(f"n{i}") for i, x in enumerate(levels)]).first()
        return list(row)

    if total <= 0:
        return cells.withColumn(out, F.lit(0).cast("long"))
    low, high, most = 0.0, 1.0, taken([1.0])[0]
    while most < total:
        steps = [high * 2.0 ** k for k in range(1, WAYS + 1)]
        got = taken(steps)
        k = next((i for i, n in enumerate(got) if n >= total), WAYS - 1)
        low, high, most = (steps[k - 1] if k else high), steps[k], got[k]
    while most != total:
        steps = sorted({x for x in np.linspace(low, high, WAYS + 1)[1:-1].tolist() if low < x < high})
        if not steps:
            break
        got = taken(steps)
        k = next((i for i, n in enumerate(got) if n >= total), len(steps))
        low = steps[k - 1] if k else low
        if k < len(steps):
            high, most = steps[k], got[k]
    if most == total:
        return cells.withColumn(out, seats(value, bound, high))
    # only quotients equal in double precision are left between the levels: the first by rank get the seats that remain
    given = stage(cells.withColumns({out: seats(value, bound, low), "_more": seats(value, bound, high) - seats(value, bound, low)}), "tied")
    left = total - given.agg(F.sum(out)).first()[0]
    tied = _ranked(given.where(F.col("_more") > 0), tie, "_rank")
    # a tied cell has one quotient at the level, so its rank is the number of seats before it
    tied = tied.withColumn(out, F.col(out) + (F.col("_rank") < left).cast("long")).drop("_rank")
    return given.where(F.col("_more") == 0).unionByName(tied).drop("_more")


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix (splitmix) of unsigned integers."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def taken_words(sizes: np.ndarray, blocks: int, quota: int, key: int) -> np.ndarray:
    """Words taken from documents of ``sizes``, in order, of a cell with ``blocks`` blocks of which ``quota`` are taken."""
    words = int(sizes.sum())
    every, more = divmod(quota, blocks)
    times = np.full(blocks, every, np.int64)
    mixed = _mixed(_mixed(np.arange(blocks, dtype=np.uint64)) ^ _mixed(np.array([key & (2**64 - 1)], np.uint64)))
    times[np.argsort(mixed, kind="stable")[:more]] += 1
    edges = np.array([k * words // blocks for k in range(blocks + 1)], np.int64)
    up_to = np.concatenate([[0], np.cumsum(times * np.diff(edges))])  # words taken before each edge
    at = np.concatenate([[0], np.cumsum(sizes)])
    k = np.minimum(np.searchsorted(edges, at, side="right") - 1, blocks - 1)
    return np.diff(up_to[k] + times[k] * (at - edges[k]))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (5, 2, 1), budget: float = 1.5, most: int = 2, block_words: int = 64,
        shard_words: int = 1 << 18, seed: int = 42) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target (its source's) and taken."""
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce(quoted(text_col), F.lit(""))
    rows = stage(docs.select(
        quoted(id_col).alias("doc_id"), quoted(source_col).cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), quoted(id_col).cast("string"), text).alias("h"), F.xxhash64(text).alias("t")), "sizes")
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))  # never null
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sources = stage(source_targets(sizes, weights, budget, most).select(
        key.alias("key"), "n", "rank", "source_size", "target",
        (F.lit(1) + F.floor((F.greatest("source_size", F.lit(1)) - 1) / shard_words)).cast("long").alias("shards")), "targets")
    total = sources.agg(F.sum("n")).first()[0] or 0
    known = join_by_key(rows.withColumn("key", key), sources, ["key"], ["h", "t"], "n", total)
    known = stage(known.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "h", "t"), F.col("shards"))).drop("key", "n", "shards"), "dealt")
    cells = known.where(F.col("size") > 0).groupBy("rank", "shard").agg(
        F.sum("size").alias("words"), F.first("source_size").alias("s"), F.first("target").alias("g"))
    blocks = F.greatest(F.round(F.col("words") / block_words), F.lit(1)).cast("long")
    cells = stage(cells.select("rank", "shard", blocks.alias("blocks"), (F.col("g") / F.col("s") * blocks).alias("v"),
                               (blocks * most).alias("cap")), "cells")
    sums = cells.agg(F.sum("v"), F.sum(F.when(F.col("v") > 0, F.col("cap")))).first()
    blocks_in_all = min(int((sums[0] or 0) + 0.5), sums[1] or 0)
    quotas = sainte_lague(cells, "v", "cap", blocks_in_all, [F.xxhash64(F.lit(seed), "rank", "shard"), F.col("rank"), F.col("shard")])
    out = ["doc_id", "source", "size", "source_size", "target"]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("h", "ascending"), ("t", "ascending"), ("size", "ascending")])
        cell = {c: table.column(c)[0].as_py() for c in ("rank", "shard", "blocks", "quota")}
        mark = int(_mixed(_mixed(np.array([cell["rank"]], np.uint64)) ^ np.array([cell["shard"]], np.uint64))[0]) ^ seed
        taken = taken_words(np.asarray(table.column("size")), cell["blocks"], cell["quota"], mark)
        return table.select(out).append_column("taken", pa.array(taken, pa.int64()))

    kinds = {f.name: f.dataType.simpleString() for f in known.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in out) + ", taken long"
    picked = known.where(F.col("size") > 0).join(quotas.select("rank", "shard", "blocks", "quota"), ["rank", "shard"])
    picked = picked.groupBy("rank", "shard").applyInArrow(run, schema)
    empty = known.where(F.col("size") == 0).select(*out, F.lit(0).cast("long").alias("taken"))
    return picked.unionByName(empty)

"""Benchmark decontamination by Wu-Manber multi-pattern search (operator 5).

Texts are reduced to words: A-Z lower-cased, words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``
(lower-case letters, digits, everything beyond ASCII), joined and framed by one
blank each.  A benchmark item's windows of ``window`` consecutive words are the
patterns; an item of fewer words is one pattern; an item without words has none.

A block of patterns is searched with the Wu-Manber tables: the shift table says
for the last ``BLOCK`` bytes of the text window how far it may move without
skipping a pattern, positions with shift zero select a bucket of patterns by the
same suffix, and the patterns of the bucket are compared directly.  Patterns
are tabled by length class, so one short pattern does not shorten all shifts.

The benchmark is the query set.  It is cut into blocks of at most
``max_patterns`` (pattern, item) pairs: a block is what the driver, one task and
one broadcast hold, whatever the benchmark's size.  Documents are scanned once per
block, a job each; a block's broadcast is destroyed before the next is made.  Spans
and items of several blocks are merged per document; with one block there is one pass
and no shuffle at all.

Defined results: null texts (documents or items) have no words.  Null item ids
are left out of ``items``, but their windows count as hits.  Repeated items are
one item.  Repeated documents are searched one by one.  Extra columns pass
through; an input column named like a result column is replaced.  Empty tables:
no documents give no rows, no items give no hits.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import fresh, quoted, ship, stage, without

BLOCK = 8
RESULT = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_spans"]
# bytes that belong to words stay (A-Z in lower case), all others become a blank
WORD_BYTES = bytes(32 if re.fullmatch(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]", c) else c[0]
                   for c in (bytes([b]).lower() for b in range(256)))


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORD_BYTES).split()


def patterns_of(text: bytes | None, window: int) -> list[bytes]:
    """Framed patterns of one item."""
    w = words(text)
    if not w:
        return []
    return [b" " + b" ".join(w[i:i + window]) + b" " for i in range(max(1, len(w) - window + 1))]


class WuManber:
    """Shift table, suffix buckets and direct comparison for patterns of one length class."""

    def __init__(self, patterns: list[tuple[bytes, frozenset]]):
        self.m = min(len(p) for p, _ in patterns)
        self.block = b = min(BLOCK, self.m)
        self.far = self.m - b + 1
        self.shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, list[tuple[bytes, frozenset]]] = {}
        for p, items in patterns:
            for end in range(b, self.m + 1):
                key, move = p[end - b:end], self.m - end
                if move < self.shift.get(key, self.far):
                    self.shift[key] = move
            self.buckets.setdefault(p[self.m - b:self.m], []).append((p, items))

    def search(self, text: bytes) -> list[tuple[int, int, frozenset]]:
        """(start, end, items) of every occurrence."""
        found, shift, far, b, m = [], self.shift.get, self.far, self.block, self.m
        end, last = m, len(text)
        while end <= last:
            key = text[end - b:end]
            move = shift(key, far)
            if move:
                end += move
                continue
            start = end - m
            for p, items in self.buckets[key]:
                if text.startswith(p, start):
                    found.append((start, start + len(p), items))
            end += 1
        return found


def tables(patterns: dict[bytes, set]) -> list[WuManber]:
    """Wu-Manber tables by length class (doubling lengths)."""
    classes: dict[int, list] = {}
    for p, items in sorted(patterns.items()):
        classes.setdefault(len(p).bit_length(), []).append((p, frozenset(items)))
    return [WuManber(group) for _, group in sorted(classes.items())]


def scan(text: bytes | None, matchers: list[WuManber]) -> tuple[int, list[tuple[int, int]], set]:
    """(number of words, merged word spans [from, to) inside occurrences, items that occur)."""
    w = words(text)
    if not w:
        return 0, [], set()
    framed = b" " + b" ".join(w) + b" "
    hits = [h for m in matchers for h in m.search(framed)]
    if not hits:
        return len(w), [], set()
    blanks = np.flatnonzero(np.frombuffer(framed, np.uint8) == 32).tolist()
    spans: list[tuple[int, int]] = []
    for start, end, _ in sorted(hits, key=lambda h: h[:2]):
        a, b = bisect_left(blanks, start), bisect_left(blanks, end - 1)
        if spans and a <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
        else:
            spans.append((a, b))
    return len(w), spans, set().union(*(h[2] for h in hits))


def _patterns(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """Distinct (pattern, item) pairs, staged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, p) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                    for p in patterns_of(t, window)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()),
                                              pa.array([r[1] for r in rows], pa.binary())], ["item", "pattern"])
    found = benchmark.select(quoted(item_col).cast("string").alias("item"), quoted(text_col).cast("binary").alias("t")) \
        .mapInArrow(run, "item string, pattern binary").distinct()
    return stage(found.orderBy("pattern", "item"), "patterns")


def _blocks(patterns: DataFrame, most: int) -> Iterator[dict]:
    """Pattern -> item ids, in blocks of at most ``most`` pairs; the driver holds one.

    A pattern of more items than a block holds is in several blocks: its spans are equal, its items add up.
    """
    block: dict[bytes, set] = {}
    size = 0
    for row in patterns.orderBy("pattern", "item").toLocalIterator():
        if size == most:
            yield block
            block, size = {}, 0
        block.setdefault(bytes(row["pattern"]), set()).add(row["item"])
        size += 1
    if block:
        yield block


def items_digest(items: set) -> str:
    return hashlib.sha256(",".join(sorted(i for i in items if i is not None)).encode()).hexdigest()


def _results(found: list[tuple[int, list[tuple[int, int]], set]]) -> list[pa.Array]:
    """Result columns of (number of words, merged spans, items) per document."""
    items = [{i for i in r[2] if i is not None} for r in found]
    return [pa.array([r[0] for r in found], pa.int64()),
            pa.array([sum(b - a for a, b in r[1]) for r in found], pa.int64()),
            pa.array([len(i) for i in items], pa.int64()),
            pa.array([items_digest(i) for i in items], pa.string()),
            pa.array([bool(r[1]) for r in found], pa.bool_()),
            pa.array([[{"from": a, "to": b} for a, b in r[1]] for r in found],
                     pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())])))]


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = 10, max_patterns: int = 200_000) -> DataFrame:
    """``docs`` plus ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated`` and ``hit_spans``
    (merged word spans [from, to) of the occurrences).

    ``max_patterns`` bounds the (pattern, item) pairs that the driver, a broadcast and a task hold at once.  A benchmark
    of one block is one pass; a larger one is a job per block, each block's broadcast gone before the next.
    """
    spark = docs.sparkSession
    ship(spark)
    keep = without(docs, RESULT)
    base = docs.select(*[quoted(c) for c in keep])
    span = T.ArrayType(T.StructType([T.StructField("from", T.LongType()), T.StructField("to", T.LongType())]))
    results = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()),
               T.StructField("items_sha256", T.StringType()), T.StructField("contaminated", T.BooleanType()),
               T.StructField("hit_spans", span)]
    schema = T.StructType(base.schema.fields + results)
    at = [c.lower() for c in keep].index(text_col.lower())
    patterns = _patterns(benchmark, item_col, item_text_col, window)
    if patterns.count() > max_patterns:
        return _block_by_block(base, patterns, at, max_patterns, schema)
    name, block = uuid.uuid4().hex, spark.sparkContext.broadcast(next(_blocks(patterns, max_patterns), {}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matchers = _matchers(name, block)
            found = [scan(t, matchers) for t in batch.column(at).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *_results(found)], schema.names)
    return base.mapInArrow(run, schema)


def _block_by_block(base: DataFrame, patterns: DataFrame, at: int, most: int, schema: T.StructType) -> DataFrame:
    """Spans and items of each block for the documents it hits, merged per document."""
    spark = base.sparkSession
    (row,) = fresh(base, "_row")
    rows = stage(base.withColumn(row, F.monotonically_increasing_id()), "documents")
    text = quoted(base.columns[at]).cast("binary")
    found = None
    for block in _blocks(patterns, most):
        name, shared = uuid.uuid4().hex, spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], name=name, shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                matchers = _matchers(name, shared)
                got = [(r, *scan(t, matchers)[1:]) for r, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
                got = [g for g in got if g[1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[0] for g in got], pa.int64()), pa.array([[x for s in g[1] for x in s] for g in got], pa.list_(pa.int64())),
                     pa.array([sorted(i for i in g[2] if i is not None) for g in got], pa.list_(pa.string()))], ["row", "spans", "items"])
        part = stage(rows.select(F.col(row).alias("row"), text.alias("t")).mapInArrow(
            run, "row long, spans array<long>, items array<string>"), "hits")
        shared.destroy()
        found = part if found is None else found.unionAll(part)
    merged = found.groupBy("row").agg(F.collect_list("spans").alias("_spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("_items"))
    spans, items = fresh(rows, "_spans", "_items")
    met = rows.join(merged.withColumnsRenamed({"row": row, "_spans": spans, "_items": items}), row, "left")
    keep = base.columns

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            lists = zip(texts, batch.column(len(keep)).to_pylist(), batch.column(len(keep) + 1).to_pylist(), strict=True)
            done = [(len(words(t)), merge_spans([p for one in s or [] for p in zip(one[::2], one[1::2], strict=True)]), set(i or [])) for t, s, i in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], *_results(done)], schema.names)
    return met.select(*[quoted(c) for c in keep], quoted(spans), quoted(items)).mapInArrow(finish, schema)


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_LAST: dict[str, list[WuManber]] = {}


def _matchers(name: str, block) -> list[WuManber]:
    """Tables of a broadcast block, built once per worker; only the latest block's tables are kept."""
    if name not in _LAST:
        _LAST.clear()
        _LAST[name] = tables(block.value)
    return _LAST[name]

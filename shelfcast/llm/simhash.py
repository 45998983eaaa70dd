"""SimHash near-dedup by tiled exact comparison (operator 10).

A text is lower-cased (A-Z), cut into words ``[^\\x20\\x09-\\x0D]+`` and into
shingles of ``shingle`` consecutive words (repeats included, joined by one
blank; a text of fewer words has its whole sequence as its only shingle).  Bit b
of the 64-bit fingerprint is 1 if it is set in over half of the shingles' XXH64
values (UTF-8, seed 42).  A text without words has fingerprint zero.
Fingerprints within ``radius`` differing bits are linked; ``component_id`` is
the smallest ``doc_id`` reachable over links.

How the comparison is distributed:

* equal fingerprints are one row (smallest id, number of rows), so a group of
  exact copies, however large, is compared once;
* a tile holds fingerprints with the same four population counts (of the four
  16-bit parts), at most ``tile`` of them; larger classes are several tiles.
  Two fingerprints within the radius differ in these counts by at most the
  radius in sum, so all other tile pairs are skipped without loss;
* every remaining tile pair is one row of an equi-join and is compared by
  numpy exclusive-or and bit counts.  Of the links found in a pair only a
  spanning forest is kept: the same components, never all pairs of a group;
* components come from rounds of neighbour minima with pointer jumping, each
  round written to the shared folder.

Work grows with the square of the number of distinct fingerprints, divided by
about 70 through the skipped tiles; that is the nature of exact tiled comparison.

Defined results: null text counts as empty.  A null ``doc_id`` takes part but
never names a component (a component of null ids only has a null id).  Repeated
rows get the same result.  Extra columns pass through; an input column named
like a result column is replaced.  An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import fresh, has_rows, join_by_key, quoted, ship, stage, text_key

RESULT = ["fingerprint", "component_id", "component"]
PARTS, PART_BITS = 4, 16


def fingerprint(text: bytes, shingle: int) -> int:
    """Fingerprint of one UTF-8 text; see the module docstring."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    joined = b" ".join(words)
    # word boundaries in the joined text, so that a shingle is one slice of it
    ends = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], ends + 1))
    stops = np.append(ends, len(joined))
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts[:len(words) - shingle + 1].tolist(), stops[shingle - 1:].tolist(), strict=True)
    h = np.fromiter((digest(joined[a:b], 42) for a, b in pairs), np.uint64, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 8192):
        bits = np.unpackbits(h[i:i + 8192].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str, out: str, shingle: int) -> DataFrame:
    """``docs``' rows with column ``out``: the fingerprint as a signed long (the text itself is left out)."""
    fields = [f for f in docs.schema.fields if f.name != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            fp = np.array([fingerprint(t or b"", shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(fp, pa.int64())],
                                             [*batch.schema.names[1:], out])

    schema = docs.select(*[quoted(f.name) for f in fields]).withColumn(out, F.lit(0).cast("long")).schema
    source = docs.select(quoted(text_col).cast("binary"), *[quoted(f.name) for f in fields])
    return source.mapInArrow(run, schema)


def _neighbours(radius: int) -> list[tuple[int, ...]]:
    """Differences of part counts within the radius; of a difference and its negative only one, zero included."""
    steps = range(-radius, radius + 1)
    return [d for d in product(steps, repeat=PARTS) if sum(map(abs, d)) <= radius and d >= (0,) * PARTS]


def _forest(a: np.ndarray, b: np.ndarray, same: bool, radius: int, block: int = 1 << 20) -> np.ndarray:
    """Spanning forest of the links between two tiles (or within one), as index pairs into ``a ++ b``."""
    left, right = [], []
    step = max(1, block // max(1, len(b)))
    for i in range(0, len(a), step):
        near = np.bitwise_count(a[i:i + step, None] ^ b[None, :]) <= radius
        x, y = np.nonzero(near)
        x = x + i
        if same:
            keep = x < y
            x, y = x[keep], y[keep]
        left.append(x)
        right.append(y + (0 if same else len(a)))
    x, y = np.concatenate(left), np.concatenate(right)
    parent: dict[int, int] = {}

    def root(v: int) -> int:
        while (p := parent.setdefault(v, v)) != v:
            parent[v] = v = parent[p]
        return v
    kept = []
    for u, v in zip(x.tolist(), y.tolist(), strict=True):
        ru, rv = root(u), root(v)
        if ru != rv:
            parent[max(ru, rv)] = min(ru, rv)
            kept.append((u, v))
    return np.array(kept, np.int64).reshape(-1, 2)


SLICE = 16  # tiles of a class that one task of the pair join takes


def links(distinct: DataFrame, fp: str, radius: int, tile: int = 512) -> DataFrame:
    """Links (u, v) of a spanning forest per tile pair over the distinct fingerprints in column ``fp``."""
    counts = [F.bit_count(F.shiftrightunsigned(F.col(fp), PART_BITS * p).bitwiseAND(F.lit((1 << PART_BITS) - 1)))
              for p in range(PARTS)]
    # a class is cut into tiles by a hash of the fingerprint; their number follows the size of the class
    classed = distinct.select(F.col(fp).alias("f"), *[c.cast("int").alias(f"p{p}") for p, c in enumerate(counts)])
    keys = [f"p{p}" for p in range(PARTS)]
    sizes = classed.groupBy(*keys).agg(F.count("*").alias("size"))
    # at most 17^4 classes exist, so this table has a bound of its own
    cut = classed.join(F.broadcast(sizes), keys)
    cut = cut.withColumn("k", F.pmod(F.xxhash64("f"), F.ceil(F.col("size") / F.lit(tile / 2))).cast("int"))
    tiles = stage(cut.groupBy(*keys, "k").agg(F.array_sort(F.collect_list("f")).alias("fs")), "tiles")
    steps = F.explode(F.array(*[F.struct(*[F.lit(x).alias(f"d{p}") for p, x in enumerate(d)])
                                for d in _neighbours(radius)])).alias("step")
    moved = tiles.select(*keys, "k", "fs", steps).select(
        *[(F.col(f"p{p}") + F.col(f"step.d{p}")).alias(f"p{p}") for p in range(PARTS)],
        F.col("k").alias("k2"), F.col("fs").alias("gs"),
        F.expr(" and ".join(f"step.d{p} = 0" for p in range(PARTS))).alias("own"))
    # all tiles of two classes would meet in one task: the tiles of the class moved to are dealt to slices of at most
    # ``SLICE``, and a tile goes to all slices of its target.  Equal classes have equal numbers of slices on both sides.
    slices = F.ceil(F.ceil(F.col("size") / F.lit(tile / 2)) / F.lit(SLICE)).cast("int")
    targets = sizes.select(*keys, slices.alias("slices"))
    moved = moved.join(F.broadcast(targets), keys).withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    dealt = tiles.join(F.broadcast(targets), keys).withColumn("slice", F.pmod(F.col("k"), F.col("slices")))
    pairs = moved.join(dealt, [*keys, "slice"]).where(~F.col("own") | (F.col("k2") <= F.col("k"))).select(
        "fs", "gs", (F.col("own") & (F.col("k2") == F.col("k"))).alias("same"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = (batch.column(c)[i].values.to_numpy().view(np.uint64) for c in (0, 1))
                same = batch.column(2)[i].as_py()
                ids = a if same else np.concatenate((a, b))
                found = _forest(a, b, same, radius)
                if len(found):
                    ends = ids[found].view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["u", "v"])
    return pairs.mapInArrow(run, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the smallest node reachable.

    Rounds: every node takes the smallest of itself and its neighbours
    (aggregated map-side first), labels jump to their label's label until they
    stand still, edges move to the labels and those inside one label go.  The
    graph shrinks each round, and each step is written to the shared folder.
    Joins here are plain equi-joins, whose hot keys adaptive execution splits.
    """
    def ordered(df: DataFrame) -> DataFrame:
        return df.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()

    edges = stage(ordered(edges), "edges")
    levels = []
    while has_rows(edges):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        up = stage(both.groupBy("u").agg(F.min("v").alias("m"))
                   .select(F.col("u").alias("node"), F.least("u", "m").alias("label")), "labels")
        moving = True
        while moving:
            far = up.select(F.col("node").alias("label"), F.col("label").alias("far"))
            up = stage(up.join(far, "label").select("node", F.col("far").alias("label"),
                                                    (F.col("far") != F.col("label")).alias("moved")), "labels")
            moving = has_rows(up.where("moved"))
        up = up.drop("moved")
        levels.append(up)
        for end in ("u", "v"):
            edges = edges.join(up.withColumnRenamed("node", end), end).drop(end).withColumnRenamed("label", end)
        edges = stage(ordered(edges), "edges")
    if not levels:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    # the label of one level is a node of the next, or final
    out = levels[-1].withColumnRenamed("label", "root")
    for low in reversed(levels[:-1]):
        above = out.withColumnRenamed("node", "label")
        out = low.join(above, "label", "left").select("node", F.coalesce("root", "label").alias("root"))
    return out


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       radius: int = 2, tile: int = 512) -> DataFrame:
    """The columns of ``docs`` but the text, plus ``fingerprint`` (16 hex digits), ``component_id`` and
    ``component`` (the smallest fingerprint reachable, which names a component also where ids repeat)."""
    ship(docs.sparkSession)
    keep = [c for c in docs.columns if c.lower() not in RESULT]
    docs = docs.select(*[quoted(c) for c in keep])
    fp, n, least, root = fresh(docs, "_fp", "_n", "_least", "_root")
    marked = stage(fingerprints(docs, text_col, fp, shingle), "fingerprints")
    distinct = stage(marked.groupBy(fp).agg(F.count("*").alias(n), F.min(quoted(id_col)).alias(least)), "distinct")
    roots = components(links(distinct, fp, radius, tile)).withColumnsRenamed({"node": fp, "root": root})
    known = stage(distinct.join(roots, fp, "left").withColumn(root, F.coalesce(root, fp)), "roots")
    # rows here are distinct fingerprints; the minimum is taken map-side first
    ids = known.groupBy(root).agg(F.min(least).alias("component_id"))
    labelled = stage(known.select(fp, n, root).join(ids, root), "labelled")
    rows = labelled.agg(F.sum(n)).first()[0] or 0
    def hexed(c: str) -> Column:
        return F.lower(F.lpad(F.hex(c), 16, "0"))
    out = join_by_key(marked, labelled, [fp], [id_col], n, rows)
    rest = [quoted(c) for c in docs.columns if c != text_col]
    return out.select(*rest, hexed(fp).alias("fingerprint"), "component_id", hexed(root).alias("component"))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                  radius: int = 2) -> DataFrame:
    """``docs`` with one row of each component: its smallest id (null last), of those the smallest text digest."""
    d, t = fresh(docs, "_d", "_t")
    ident = docs.select(quoted(id_col).alias("d"), text_key(quoted(text_col)).alias("t"), quoted(text_col).alias("text"))
    found = simhash_components(ident, "d", "text", shingle, radius)
    # one row per component, combined map-side: a component that holds a third of all rows is no hot group
    best = found.groupBy("component").agg(F.min(F.struct(F.col("d").isNull().alias("z"), "d", "t")).alias("k")) \
        .select(F.col("k.d").alias(d), F.col("k.t").alias(t))
    met = docs.join(best, quoted(id_col).eqNullSafe(F.col(d)) & (text_key(quoted(text_col)) == F.col(t)))
    return met.dropDuplicates([d, t]).drop(d, t)

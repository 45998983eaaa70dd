"""Katz backoff bigram language model (operator 2).

Tokens: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, then one end token.  With
counts c from the training texts (N tokens, V distinct):

* unigrams: ``P(w) = d_c c / N``; all words unseen in training share the mass the
  discounts leave, as one class (V + 1 outcomes, as in the base score);
* bigrams: ``P(w|h) = d_r r / c(h)`` for a pair seen r times, else
  ``alpha(h) P(w)``; a history unseen in training leaves ``P(w)``;
* ``d_r`` for r up to ``K`` is Katz's Good-Turing discount from the counts of
  counts (absolute discounting where these are degenerate, as in tiny corpora);
  larger counts give up ``TAIL`` of a count, so every history has mass to give;
* ``alpha(h) = (1 - sum of P(w|h)) / (1 - sum of P(w))`` over the words w seen
  after h, so that all probabilities after any history sum to one exactly.

How it is distributed.  A *block* is what one task reads (at most
``BLOCK_TOKENS`` tokens, or one longer text); it holds each distinct word and
pair once, so a word that makes up a third of all tokens is one entry per
block.  Entries are 64-bit digests, packed and dealt to buckets by their top
bits; the number of buckets follows the number of entries, so a bucket has a
bounded size.  A bucket adds up counts, stores its part of the count table and
answers each block.  Three such exchanges give word counts, pair counts and
backoff weights:

1. blocks -> word buckets: c(w), counts of counts, N, V;
2. blocks -> pair buckets: r, and which block *owns* a pair (the first that has
   it in training), so that sums over distinct pairs are taken once;
3. blocks with both answers -> history buckets: sums of the owned pairs give
   alpha(h); blocks that back off at h get it back and finish their scores.

All tables (``words``, ``pairs``, ``backoff``) are Parquet in the shared folder,
one row per bucket.  Nothing but a few sums reaches the driver.

Defined results: null or empty text is the end token alone.  Without training
rows nothing is known: N and V are 0, and the class of unseen words is the only
outcome, with probability one (the base score says the same).  Repeated rows count and score one
by one.  Null ids are scored as any other (their text is '' for the fold).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import quoted, ship, stage

K = 5
TAIL = 0.01
BLOCK_TOKENS = 2_000_000
BUCKET_ENTRIES = 1 << 21
END, START = b"\n", b"\r"  # no word contains white space
START_KEY = np.uint64(xxhash.xxh64_intdigest(START))
END_KEY = np.uint64(xxhash.xxh64_intdigest(END))


# ---- packed arrays -------------------------------------------------------------------------------------------------

def pack(a: np.ndarray) -> bytes:
    """8-byte values by byte plane, compressed: high planes of small numbers cost nothing."""
    raw = np.ascontiguousarray(a).view(np.uint8).reshape(-1, 8) if a.dtype.itemsize == 8 else \
        np.ascontiguousarray(a.astype(np.uint64)).view(np.uint8).reshape(-1, 8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(raw.T).tobytes())


def unpack(b: bytes, dtype=np.uint64) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view(dtype).reshape(-1)


def pack_sorted(a: np.ndarray) -> bytes:
    return pack(np.diff(a, prepend=np.uint64(0)))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b), dtype=np.uint64)


def pair_keys(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """64-bit digests of (history, word) digests; evenly spread, so their top bits deal out evenly."""
    x = h * np.uint64(0x9E3779B97F4A7C15) + (w ^ (w >> np.uint64(29)))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# ---- blocks --------------------------------------------------------------------------------------------------------

class _Numbers(dict):
    """Running number of each distinct word."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Block:
    """Words (sorted digests), their training counts, and all token sequences of some documents."""

    def __init__(self, words: np.ndarray, tokens: np.ndarray, sizes: np.ndarray, train: np.ndarray):
        self.words, self.tokens, self.sizes, self.train = words, tokens, sizes, train
        self.in_train = np.repeat(train, sizes)

    @classmethod
    def read(cls, row: dict) -> Block:
        order = unpack(row["ranks"]).astype(np.int64)
        return cls(unpack_sorted(row["words"]), order[unpack(row["tokens"]).astype(np.int64)],
                   np.asarray(row["sizes"], np.int64), np.asarray(row["train"], bool))

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.in_train], minlength=len(self.words)).astype(np.uint64)

    def histories(self) -> np.ndarray:
        """Word number of each token's predecessor; ``len(words)`` stands for the start."""
        h = np.empty_like(self.tokens)
        h[1:] = self.tokens[:-1]
        h[np.cumsum(self.sizes) - self.sizes] = len(self.words)
        return h

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sorted distinct pair digests, position of one token of each, pair number of every token)."""
        known = np.append(self.words, START_KEY)
        return np.unique(pair_keys(known[self.histories()], self.words[self.tokens]), return_index=True, return_inverse=True)


def _block_row(task: int, nth: int, numbers: _Numbers, tokens: list[np.ndarray], ids: list, train: list[bool]) -> dict:
    digests = np.fromiter((xxhash.xxh64_intdigest(w) for w in numbers), np.uint64, len(numbers))
    words, at = np.unique(digests, return_inverse=True)
    flat = at[np.concatenate(tokens)]
    # tokens are stored by rank of frequency: small numbers for frequent words
    ranks = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
    place = np.empty(len(words), np.int64)
    place[ranks] = np.arange(len(words))
    return {"block": (task << 24) | nth, "ids": ids, "train": train, "sizes": [len(t) for t in tokens],
            "n_words": len(words), "words": pack_sorted(words), "ranks": pack(ranks), "tokens": pack(place[flat])}


def blocks(docs: DataFrame, id_col: str, text_col: str, train) -> DataFrame:
    """One row per block; ``train`` is the condition of training rows."""
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(id_type)),
                           T.StructField("train", T.ArrayType(T.BooleanType())), T.StructField("sizes", T.ArrayType(T.LongType())),
                           T.StructField("n_words", T.LongType()), T.StructField("words", T.BinaryType()),
                           T.StructField("ranks", T.BinaryType()), T.StructField("tokens", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, nth, numbers, tokens, ids, flags, size, arrow = TaskContext.get().partitionId(), 0, _Numbers(), [], [], [], 0, None

        def done() -> pa.RecordBatch:
            row = _block_row(task, nth, numbers, tokens, ids, flags)
            return pa.RecordBatch.from_pylist([row], schema=arrow)
        for batch in batches:
            if arrow is None:
                arrow = pa.schema([("block", pa.int64()), ("ids", pa.list_(batch.schema.field(0).type)),
                                   ("train", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64())), ("n_words", pa.int64()),
                                   ("words", pa.binary()), ("ranks", pa.binary()), ("tokens", pa.binary())])
            for i, flag, text in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                words = (text or b"").lower().split()
                words.append(END)
                tokens.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
                ids.append(i)
                flags.append(bool(flag))
                size += len(words)
                if size >= BLOCK_TOKENS:
                    yield done()
                    nth, numbers, tokens, ids, flags, size = nth + 1, _Numbers(), [], [], [], 0
        if tokens:
            yield done()
    return docs.select(quoted(id_col), train, quoted(text_col).cast("binary")).mapInArrow(run, schema)


# ---- exchanges -----------------------------------------------------------------------------------------------------

ENTRY = "bucket int, block long, n long, keys binary, counts binary"
ANSWER = "bucket int, block long, keys binary, data binary, v long, n long, r1 long, r2 long, r3 long, r4 long, r5 long, r6 long"


def _bits(entries: int) -> int:
    """Number of top bits that name a bucket, so that a bucket has about ``BUCKET_ENTRIES`` entries at most."""
    return max(0, math.ceil(math.log2(max(1, entries / BUCKET_ENTRIES))))


def cuts(keys: np.ndarray, bits: int) -> np.ndarray:
    """Borders of the buckets in sorted keys."""
    tops = (np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.zeros(0, np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, tops), [len(keys)]))


def _entries(block_rows: DataFrame, bits: int, of_pairs: bool) -> DataFrame:
    """(bucket, block, keys, training counts) of the words, or pairs, of all blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b = Block.read(row)
                if of_pairs:
                    keys, _, number = b.pairs()
                    counts = np.bincount(number[b.in_train], minlength=len(keys)).astype(np.uint64)
                else:
                    keys, counts = b.words, b.word_counts()
                at = cuts(keys, bits)
                out = [{"bucket": k, "block": row["block"], "n": int(e - a), "keys": pack_sorted(keys[a:e]),
                        "counts": pack(counts[a:e])} for k, (a, e) in enumerate(zip(at, at[1:], strict=False)) if e > a]
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                    ("bucket", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]))
    # few large rows: one block is in memory at a time
    return block_rows.select("block", "train", "sizes", "words", "ranks", "tokens").mapInArrow(run, ENTRY)


def _add_up(table: pa.Table) -> pa.Table:
    """A bucket's totals: its part of the count table (block -1), sums, and each block's answer ``2 * total + owner``."""
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    keys = np.concatenate([unpack_sorted(r["keys"]) for r in rows])
    counts = np.concatenate([unpack(r["counts"]) for r in rows])
    order = np.argsort(keys, kind="stable")
    keys, own = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    totals = np.add.reduceat(own, starts)
    # the first block that has the key in training owns it
    first = np.minimum.reduceat(np.where(own > 0, np.arange(len(own)), len(own)), starts)
    answer = np.repeat(totals, np.diff(np.append(starts, len(keys)))) * np.uint64(2)
    answer[first[first < len(own)]] += np.uint64(1)
    back = np.empty_like(answer)
    back[order] = answer
    out, a = [], 0
    for r in rows:
        out.append({"bucket": r["bucket"], "block": r["block"], "data": pack(back[a:a + r["n"]])})
        a += r["n"]
    seen = totals > 0
    out.append({"bucket": rows[0]["bucket"], "block": -1, "keys": pack_sorted(keys[starts][seen]), "data": pack(totals[seen]),
                "v": int(seen.sum()), "n": int(totals.sum()), **{f"r{i}": int((totals == i).sum()) for i in range(1, K + 2)}})
    return pa.Table.from_pylist(out, schema=pa.schema(
        [("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("data", pa.binary()),
         *((c, pa.int64()) for c in ("v", "n", "r1", "r2", "r3", "r4", "r5", "r6"))]))


class Sums(NamedTuple):
    v: int
    n: int
    of: tuple[int, ...]  # number of types with count 1 .. K + 1


def _exchange(block_rows: DataFrame, bits: int, of_pairs: bool, tag: str) -> tuple[DataFrame, Sums]:
    """Answers to the blocks and the sums over the count table."""
    met = stage(_entries(block_rows, bits, of_pairs).groupBy("bucket").applyInArrow(_add_up, ANSWER), tag)
    cols = ["v", "n", *(f"r{i}" for i in range(1, K + 2))]
    s = met.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols]).first()
    return met, Sums(s["v"], s["n"], tuple(s[f"r{i}"] for i in range(1, K + 2)))


def discounts(n: tuple[int, ...]) -> np.ndarray:
    """d_1 .. d_K by Katz's formula; absolute discounting if a count of counts does not allow it."""
    if all(n[:K]):
        common = (K + 1) * n[K] / n[0]
        if common < 1:
            d = [((r + 1) * n[r] / n[r - 1] / r - common) / (1 - common) for r in range(1, K + 1)]
            if all(0 < x < 1 for x in d):
                return np.array(d)
    gap = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    return np.array([(r - gap) / r for r in range(1, K + 1)])


def discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    """d_r * r."""
    r = counts.astype(np.float64)
    return np.where(counts <= K, np.concatenate(([0.0], d))[np.minimum(counts, K).astype(np.int64)] * r, r - TAIL)


class Model(NamedTuple):
    """The few numbers every task needs."""

    n: int
    v: int
    unknown: float  # probability of the class of unseen words
    d1: np.ndarray
    d2: np.ndarray
    texts: int  # count of the start as a history
    bits1: int
    bits2: int

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, discounted(counts, self.d1) / max(self.n, 1), self.unknown)


# ---- evaluation ----------------------------------------------------------------------------------------------------

PART = "kind int, bucket int, block long, doc int, train boolean, n_tokens long, n_known long, base double, part double, " \
       "keys binary, a binary, b binary"


def _joined(answers: list[dict]) -> np.ndarray:
    """Answers of all buckets in key order."""
    return np.concatenate([unpack(r["data"]) for r in sorted(answers, key=lambda r: r["bucket"])])


def _evaluate(model: Model):
    """Scores of a block up to the backoff weights, its part of their sums, and its questions."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own = next(r for r in rows if r["kind"] == 0)
        b = Block.read(own)
        c = (_joined([r for r in rows if r["kind"] == 1]) >> np.uint64(1)).astype(np.int64)
        keys, at, number = b.pairs()
        told = _joined([r for r in rows if r["kind"] == 2])
        r, owner = (told >> np.uint64(1)).astype(np.int64), (told & np.uint64(1)).astype(bool)
        p = model.unigram(c)
        h, w = b.histories(), b.tokens
        ch = np.append(c, model.texts)
        # one value per distinct pair, then per token
        hp, wp = h[at], w[at]
        del told, at
        with np.errstate(divide="ignore"):
            value = np.where(r > 0, np.log10(discounted(r, model.d2) / np.maximum(ch[hp], 1)), np.log10(p)[wp])
        docs = np.repeat(np.arange(len(b.sizes)), b.sizes)
        part = np.bincount(docs, value[number], len(b.sizes))
        del value
        base = np.bincount(docs, np.log10((c + 1) / (model.n + model.v + 1))[w], len(b.sizes))
        known = np.bincount(docs, c[w] > 0, len(b.sizes))
        ids = own["ids"]
        out = [{"kind": 3, "block": own["block"], "doc": i, "id": ids[i], "train": bool(b.train[i]),
                "n_tokens": int(b.sizes[i]), "n_known": int(known[i]), "base": base[i], "part": part[i]}
               for i in range(len(b.sizes))]
        # owned pairs: what their histories give up, and the probability of the words seen after them
        hk = np.append(b.words, START_KEY)
        mine = np.flatnonzero(owner)
        give = np.bincount(hp[mine], (r - discounted(r, model.d2))[mine], len(hk)) / np.maximum(ch, 1)
        after = np.bincount(hp[mine], p[wp[mine]], len(hk))
        some = np.flatnonzero(np.bincount(hp[mine], minlength=len(hk)))
        _deal(out, 4, own["block"], hk, some, model.bits1, give, after)
        # questions: histories seen in training at which a pair unseen there occurs
        back = np.flatnonzero((r[number] == 0) & (ch[h] > 0))
        if len(back):
            asked, which = np.unique(h[back], return_inverse=True)
            order = np.argsort(hk[asked])
            place = np.empty(len(asked), np.int64)
            place[order] = np.arange(len(asked))
            _deal(out, 5, own["block"], hk, asked, model.bits1)
            line, many = np.unique(docs[back].astype(np.int64) * len(asked) + place[which], return_counts=True)
            out.append({"kind": 6, "block": own["block"], "bucket": len(asked), "a": pack_sorted(line.astype(np.uint64)),
                        "b": pack(many)})
        return pa.Table.from_pylist(out, schema=_part_schema(table.schema.field("ids").type.value_type))
    return run


def _part_schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("doc", pa.int32()), ("id", id_type),
                      ("train", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()),
                      ("part", pa.float64()), ("keys", pa.binary()), ("a", pa.binary()), ("b", pa.binary())])


def _deal(out: list, kind: int, block: int, keys: np.ndarray, some: np.ndarray, bits: int, *values: np.ndarray) -> None:
    """Append one row per bucket with the sorted keys ``keys[some]`` and their values."""
    some = some[np.argsort(keys[some])]
    at = cuts(keys[some], bits)
    for k, (a, e) in enumerate(zip(at, at[1:], strict=False)):
        if e > a:
            out.append({"kind": kind, "bucket": k, "block": block, "keys": pack_sorted(keys[some[a:e]]),
                        **{name: pack(v[some[a:e]]) for name, v in zip("ab", values, strict=False)}})


def _weights(table: pa.Table) -> pa.Table:
    """Backoff weights of a bucket's histories: the table row (block -1) and the answers (log10) to the blocks."""
    rows = table.to_pylist()
    given = [r for r in rows if r["kind"] == 4]
    keys = np.concatenate([unpack_sorted(r["keys"]) for r in given])
    known, at = np.unique(keys, return_inverse=True)
    give = np.bincount(at, np.concatenate([unpack(r["a"], np.float64) for r in given]), len(known))
    after = np.bincount(at, np.concatenate([unpack(r["b"], np.float64) for r in given]), len(known))
    alpha = give / (1 - after)
    out = [{"bucket": rows[0]["bucket"], "block": -1, "keys": pack_sorted(known), "data": pack(alpha)}]
    for r in rows:
        if r["kind"] == 5:
            asked = unpack_sorted(r["keys"])
            out.append({"bucket": r["bucket"], "block": r["block"], "data": pack(np.log10(alpha[np.searchsorted(known, asked)]))})
    return pa.Table.from_pylist(out, schema=pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()),
                                                       ("data", pa.binary())]))


def _finish(table: pa.Table) -> pa.Table:
    """(doc, sum of backoff weights) of one block's documents that back off."""
    rows = table.to_pylist()
    where = next(r for r in rows if r["kind"] == 6)
    logs = np.concatenate([unpack(r["a"], np.float64) for r in sorted(
        (r for r in rows if r["kind"] == 7), key=lambda r: r["bucket"])])
    line, many = unpack_sorted(where["a"]).astype(np.int64), unpack(where["b"], np.int64)
    docs, which = np.divmod(line, where["bucket"])
    found, at = np.unique(docs, return_inverse=True)
    return pa.table({"block": pa.array(np.full(len(found), where["block"], np.int64)), "doc": pa.array(found.astype(np.int32)),
                     "more": pa.array(np.bincount(at, logs[which] * many, len(found)))})


class KatzScores(NamedTuple):
    scores: DataFrame  # id, train, n_tokens, n_known, train_tokens, base_score, score
    words: DataFrame   # count table by bucket (packed)
    pairs: DataFrame   # count table by bucket (packed)
    backoff: DataFrame  # weights by bucket (packed)


def katz_scores(docs: DataFrame, train, id_col: str = "doc_id", text_col: str = "text") -> KatzScores:
    """Scores of all texts, learnt from the rows that satisfy the condition ``train``; see the module docstring."""
    ship(docs.sparkSession)
    held = stage(blocks(docs, id_col, text_col, train.alias("train")), "katz-blocks")
    entries = held.agg(F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum(F.aggregate(
        "sizes", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0)), F.coalesce(F.sum(F.size(F.filter("train", lambda x: x))),
                                                                                   F.lit(0))).first()
    bits1, bits2 = _bits(entries[0]), _bits(entries[1])
    words, one = _exchange(held, bits1, False, "katz-words")
    pairs, two = _exchange(held, bits2, True, "katz-pairs")
    d1, d2 = discounts(one.of), discounts(two.of)
    left = float(sum((1 - d1[r - 1]) * r * one.of[r - 1] for r in range(1, K + 1))) + TAIL * (one.v - sum(one.of[:K]))
    model = Model(one.n, one.v, left / one.n if one.n else 1.0, d1, d2, entries[2], bits1, bits2)
    id_type = docs.schema[id_col].dataType
    answers = [a.where("block >= 0").select("block", F.lit(k).alias("kind"), "bucket", "data")
               for k, a in ((1, words), (2, pairs))]
    own = held.withColumn("kind", F.lit(0)).drop("n_words")
    both = own.unionByName(answers[0].unionByName(answers[1]), allowMissingColumns=True)
    part_type = PART.replace("doc int,", f"doc int, id {id_type.simpleString()},")
    parts = stage(both.groupBy("block").applyInArrow(_evaluate(model), part_type), "katz-parts")
    weights = stage(parts.where("kind in (4, 5)").select("kind", "bucket", "block", "keys", "a", "b").groupBy("bucket")
                    .applyInArrow(_weights, "bucket int, block long, keys binary, data binary"), "katz-backoff")
    told = weights.where("block >= 0").select("block", F.lit(7).alias("kind"), "bucket", F.col("data").alias("a"),
                                              F.lit(None).cast("binary").alias("b"))
    more = parts.where("kind = 6").select("block", "kind", "bucket", "a", "b").unionByName(told).groupBy("block") \
        .applyInArrow(_finish, "block long, doc int, more double")
    texts = parts.where("kind = 3").join(more, ["block", "doc"], "left")
    scores = texts.select(F.col("id").alias(id_col), "train", "n_tokens", "n_known", F.lit(one.n).cast("long").alias("train_tokens"),
                          F.col("base").alias("base_score"), (F.col("part") + F.coalesce("more", F.lit(0.0))).alias("score"))
    table = ["bucket", "keys", "data"]
    return KatzScores(scores, *[t.where("block = -1").select(*table) for t in (words, pairs, weights)])

"""Alignment of two tokenizers over a corpus, Arrow-native (operator 12).

A text is encoded twice, with a blank before it: by a byte-level BPE (A, whose
entries spell bytes) and by a piece model with byte fallback (B, which adds the
blank itself).  In bytes both spell the same text, so tokens of A and B can be
compared by the byte ranges they cover.

Inside a task, a chunk of texts (about ``CHUNK`` bytes, or one longer text) is a
pair of Arrow lists of ids:

* the lists are flattened, ``list_parent_indices`` says which document a token is
  of, and a cumulative sum of token lengths less the sum before the document's
  first token gives where it ends;
* (document, end) is one 64-bit key.  A full outer hash join of both sides on it
  has a row for each place where a token of A or B ends; filling ids backward
  over the sorted rows names the pair of tokens that share the bytes before
  that place.  Every overlapping pair is such a row exactly once: these are the
  *links*.  Rows that both sides have cut the document into *groups*;
* group texts are joined lists of id strings.

Over the corpus, an id pair's count is the number of documents that hold it
linked.  A document lists each of its pairs once (with its number of links), so
``Table.group_by`` partial counts per task, added up by Spark, are that count; the
highest of an A id is a window over its pairs (at most as many as B has ids).
To bring counts back to documents, the at most ``hot`` most frequent pairs are
broadcast (the threshold comes from a histogram of counts, so the bound holds
whatever the corpus) and looked up in place; the other pairs meet their
documents in a shuffle join, in which no pair is frequent.

Defined results: a null or empty text, or one whose joined A or B bytes differ
from blank + text (a text with U+2581, or that the piece model rewrites), has no
tokens: all numbers 0, the digest ''.  Rows are counted one by one, also where
id and text repeat.  Ids may be null.  Only the id and the text are read, so
other columns may have any name.  An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import quoted, ship, stage

CHUNK = 1 << 20           # bytes of text that are aligned together
PENDING = 2_000_000       # partial counts that a task holds before it adds them up
SHIFT = 32                # document number above, byte offset below
# The byte-level pre-tokeniser's pattern, and characters whose class is the same in every Unicode version.
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SETTLED = r"\t\n\r -~¡-ƺΑ-ΡΣ-ώА-яЁё‐-‧ぁ-ゖァ-ヺ一-龥가-힣"
UNSETTLED = re.compile(f"[^{SETTLED}]")


class Side(NamedTuple):
    """A vocabulary: the bytes, their number and the decimal of each id."""

    data: pa.Array
    length: pa.Array
    name: pa.Array


def _side(entries: list[bytes]) -> Side:
    return Side(pa.array(entries, pa.binary()), pa.array([len(e) for e in entries], pa.int64()),
                pa.array([str(i) for i in range(len(entries))]))


class Encoders:
    """Both tokenizers of one worker process."""

    def __init__(self, byte_bpe: str, piece_model: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(byte_bpe)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        # the byte-level alphabet: visible Latin-1 bytes stand for themselves, the others for code points from 256
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [x for x in range(256) if x not in shown]
        byte_of = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(hidden)}
        spelled = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.side_a = _side([bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t in spelled])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.side_b = _side([bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                             for i, p in enumerate(pieces)])
        self.ranked = self._ranked(byte_bpe)

    def _ranked(self, byte_bpe: str):
        """The same vocabulary in an encoder that merges by rank, if its ids are in the order of its merges; else None."""
        import tiktoken
        with open(byte_bpe, encoding="utf-8") as f:
            model = json.load(f)["model"]
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        if [model["vocab"].get(t) for t in merged] != list(range(256, 256 + len(merged))):
            return None
        ranks = {e: i for i, e in enumerate(self.side_a.data.to_pylist()[:256 + len(merged)])}
        return tiktoken.Encoding("byte-bpe", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens={})

    def ids_a(self, text: str) -> np.ndarray:
        """A's ids of blank + text; texts with characters outside ``SETTLED`` go through the tokenizer file's own pre-tokeniser."""
        if self.ranked and not UNSETTLED.search(text):
            return self.ranked.encode_to_numpy(" " + text, disallowed_special=())
        return np.array(self.a.encode(" " + text, add_special_tokens=False).ids, np.uint32)

    def ids_b(self, text: str) -> np.ndarray:
        return np.array(self.b.encode(text), np.uint32)


_ENCODERS: dict[tuple[str, str], Encoders] = {}


def _encoders(byte_bpe: str, piece_model: str) -> Encoders:
    if (byte_bpe, piece_model) not in _ENCODERS:
        _ENCODERS[byte_bpe, piece_model] = Encoders(byte_bpe, piece_model)
    return _ENCODERS[byte_bpe, piece_model]


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    flat = np.concatenate([np.empty(0, np.uint32), *ids]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, ids)]), pa.int32()), pa.array(flat))


def _spells(lists: pa.ListArray, side: Side, want: list[bytes]) -> np.ndarray:
    """Which documents' joined token bytes are the wanted ones."""
    got = side.data.take(lists.flatten())
    data = b"".join(got.to_pylist()) if got.offset else bytes(memoryview(got.buffers()[2] or b""))
    total = np.concatenate([[0], np.cumsum(np.asarray(side.length.take(lists.flatten())))])
    ends = total[np.asarray(lists.offsets)]
    return np.array([ends[i + 1] - ends[i] == len(w) and data[ends[i]:ends[i + 1]] == w for i, w in enumerate(want)], bool)


def _ends(lists: pa.ListArray, side: Side) -> pa.Array:
    """(document, end) keys of all tokens in order."""
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    reach = pc.cumulative_sum(side.length.take(flat))
    before = np.concatenate([[0], np.asarray(reach)])[np.asarray(lists.offsets)[:-1]]
    end = pc.subtract(reach, pa.array(before).take(parent))
    return pc.bit_wise_or(pc.shift_left(pc.cast(parent, pa.int64()), pa.scalar(SHIFT, pa.int64())), end)


def _groups(ids: pa.Array, side: Side, last: np.ndarray) -> pa.Array:
    """Ids of each group as text; ``last`` marks the tokens that end a group."""
    cuts = np.concatenate([[0], np.flatnonzero(last) + 1])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), side.name.take(ids)), ",")


def align(texts: list[str | None], enc: Encoders, base: int) -> dict[str, pa.Array]:
    """Columns n_a, n_b, n_groups, n_links, groups_sha256, codes and times for texts; code: A id x ``base`` + B id."""
    asked = [i for i, t in enumerate(texts) if t]
    want = [b" " + texts[i].encode() for i in asked]
    a, b = _lists([enc.ids_a(texts[i]) for i in asked]), _lists([enc.ids_b(texts[i]) for i in asked])
    sound = _spells(a, enc.side_a, want) & _spells(b, enc.side_b, want)
    at = np.array(asked, np.int64)[sound]  # row of each aligned document
    if not sound.all():
        a, b = a.filter(pa.array(sound)), b.filter(pa.array(sound))
    ids_a, ids_b = pc.list_flatten(a), pc.list_flatten(b)
    links = pa.table({"key": _ends(a, enc.side_a), "a": ids_a}).join(
        pa.table({"key": _ends(b, enc.side_b), "b": ids_b}), "key", join_type="full outer", use_threads=False).sort_by("key")
    links = links.combine_chunks()
    is_a, is_b = (np.asarray(pc.is_valid(links.column(c))) for c in ("a", "b"))
    both = is_a & is_b
    document = np.asarray(links.column("key")) >> SHIFT
    groups = np.bincount(document[both], minlength=len(at))
    text = pc.binary_join_element_wise(_groups(ids_a, enc.side_a, both[is_a]), _groups(ids_b, enc.side_b, both[is_b]), "|")
    text = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(groups)]), pa.int32()), text), ";")
    # each document's distinct pairs with their number of links
    fill = lambda c: np.asarray(pc.fill_null_backward(links.column(c))).astype(np.int64)
    code = fill("a") * base + fill("b")
    seen, order = pa.table({"document": document, "code": code}), [("document", "ascending"), ("code", "ascending")]
    seen = seen.group_by(["document", "code"], use_threads=False).aggregate([([], "count_all")]).sort_by(order).combine_chunks()
    owner = np.asarray(seen.column("document"))

    def spread(values, kind) -> np.ndarray:
        out = np.zeros(len(texts), kind)
        out[at] = values
        return out

    digest = [""] * len(texts)
    for i, s in zip(at.tolist(), text.to_pylist(), strict=True):
        digest[i] = hashlib.sha256(s.encode()).hexdigest()
    starts = np.concatenate([[0], np.cumsum(spread(np.bincount(owner, minlength=len(at)), np.int64))])
    lists = lambda v: pa.ListArray.from_arrays(pa.array(starts, pa.int32()), v)
    flat = lambda c: seen.column(c).combine_chunks() if seen.num_rows else pa.array([], pa.int64())
    return {"n_a": pa.array(spread(np.diff(np.asarray(a.offsets)), np.int64)),
            "n_b": pa.array(spread(np.diff(np.asarray(b.offsets)), np.int64)),
            "n_groups": pa.array(spread(groups, np.int64)),
            "n_links": pa.array(spread(np.bincount(document, minlength=len(at)), np.int64)),
            "groups_sha256": pa.array(digest), "codes": lists(flat("code")), "times": lists(flat("count_all").cast(pa.int32()))}


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > CHUNK:
            yield start, i
            start, size = i, 0
        size += n
    if len(texts) > start:
        yield start, len(texts)


def aligned(docs: DataFrame, byte_bpe: str, piece_model: str, base: int, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per document: row number, doc_id, sizes, digest, and its pairs (codes, times)."""
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        enc = _encoders(byte_bpe, piece_model)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i, j in _chunks(texts):
                got = align(texts[i:j], enc, base)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + j - i)), batch.column(0).slice(i, j - i),
                                                  *got.values()], ["row", "doc_id", *got])
                row += j - i

    return docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).alias("text")).mapInArrow(
        run, f"row long, doc_id {id_type.simpleString()}, n_a long, n_b long, n_groups long, n_links long, "
             "groups_sha256 string, codes array<long>, times array<int>")


def pair_counts(docs: DataFrame, base: int) -> DataFrame:
    """code, count (documents that hold the pair linked) and best (the count is its A id's highest)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def merged() -> pa.Table:
            return pa.concat_tables(held).group_by("code", use_threads=False).aggregate([("n", "sum")]).rename_columns(["code", "n"])

        for batch in batches:
            part = pa.table({"code": pc.list_flatten(batch.column(0))}).group_by("code", use_threads=False)
            held.append(part.aggregate([([], "count_all")]).rename_columns(["code", "n"]))
            if sum(t.num_rows for t in held) > PENDING:
                held[:] = [merged()]
                if held[0].num_rows > PENDING // 2:
                    yield from held[0].to_batches()
                    held.clear()
        if held:
            yield from merged().to_batches()

    counts = docs.select("codes").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("count"))
    top = F.max("count").over(Window.partitionBy(F.floor(F.col("code") / base)))
    return counts.select("code", "count", (F.col("count") == top).alias("best"))


def frequent(pairs: DataFrame, most: int) -> tuple[int, bool]:
    """The least count c so that at most ``most`` pairs (up to a bucket's width) have count >= c; whether others remain."""
    bucket = F.floor(F.log2(F.col("count")) * 16)  # below 1024 buckets, whatever the counts
    left, least, rest = most, None, False
    for r in pairs.groupBy(bucket.alias("b")).agg(F.count("*").alias("n"), F.min("count").alias("c")).orderBy(F.desc("b")).collect():
        if r["n"] > left:
            rest = True
            break
        left, least = left - r["n"], r["c"]
    return (least if least is not None else 1 << 62), rest


def token_alignment(docs: DataFrame, byte_bpe: str, piece_model: str, id_col: str = "doc_id", text_col: str = "text",
                    hot: int = 1 << 20) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    ship(spark)
    base = 1 << 20  # above any B id, so a code is one long
    rows = stage(aligned(docs, byte_bpe, piece_model, base, id_col, text_col), "aligned")
    pairs = stage(pair_counts(rows, base), "pairs")
    least, rest = frequent(pairs, hot)
    known = pairs.where(F.col("count") >= least).orderBy("code").toArrow()  # at most ``hot`` rows
    table = spark.sparkContext.broadcast(tuple(np.asarray(known.column(c)) for c in ("code", "count", "best")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, best = table.value
        for batch in batches:
            col = dict(zip(batch.schema.names, batch.columns, strict=True))
            code = np.asarray(pc.list_flatten(col["codes"]))
            times = np.asarray(pc.list_flatten(col["times"])).astype(np.int64)
            parent = np.asarray(pc.list_parent_indices(col["codes"]))
            at = np.searchsorted(codes, code)
            hit = np.zeros(len(code), bool)
            inside = at < len(codes)
            hit[inside] = codes[at[inside]] == code[inside]
            at = at[hit]
            sums = []
            for values in (best[at], counts[at]):
                out = np.zeros(batch.num_rows, np.int64)
                np.add.at(out, parent[hit], times[hit] * values)
                sums.append(pa.array(out))
            starts = np.concatenate([[0], np.cumsum(np.bincount(parent[~hit], minlength=batch.num_rows))])
            cold = [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(v[~hit])) for v in (code, times)]
            yield pa.RecordBatch.from_arrays([*[col[c] for c in kept], *sums, *cold],
                                             [*kept, "n_best", "count_sum", "cold", "cold_times"])

    kept = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    found = rows.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in kept)
                            + ", n_best long, count_sum long, cold array<long>, cold_times array<long>")
    if rest:
        found = stage(found, "alignment")
        cold = found.select("row", F.explode(F.arrays_zip("cold", "cold_times")).alias("z")).select(
            "row", F.col("z.cold").alias("code"), F.col("z.cold_times").alias("t"))
        more = cold.join(pairs.where(F.col("count") < least), "code").groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("t")).otherwise(0)).alias("more_best"), F.sum(F.col("t") * F.col("count")).alias("more_sum"))
        found = found.join(more, "row", "left").withColumns({
            "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
            "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))})
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

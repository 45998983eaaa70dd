"""Best-fit packing of token sequences, bulk-synchronous (operator 6).

A document's tokens are its text's ids (no special tokens added) and one end
id.  Documents longer than ``capacity`` are cut into pieces of ``capacity``
tokens, the last one may be shorter; others stay whole.  Pieces are put into
sequences of at most ``capacity`` tokens.

The method, in rounds: documents and gaps are sorted by size; a sweep from large
to small gives each document its successor, the smallest gap still free that
holds it; where several documents want one gap the rank (length, id, piece)
decides; gaps are updated and the round repeats until all are placed.  A document
that no gap holds opens a sequence.

Pieces of one length are interchangeable, and so are gaps of one size, so a sweep
need not touch rows: it moves whole *runs* (a length and a range of ranks, a gap
size and a range of sequence numbers).  There are at most ``capacity`` lengths
and, over all rounds, a number of runs that depends on ``capacity`` only, never
on the number of documents.  Therefore:

* ranks are made at cluster scale: pieces are range-sorted by (length, id,
  piece), each task numbers its rows per length, and per-task counts (one row
  per task and length; tasks hold contiguous ranges, so at most tasks +
  ``capacity`` rows) give the starts;
* the rounds run over the run table (bounded by ``capacity``);
* the resulting plan (length, rank range -> sequence range, offset) is sent to
  all tasks, and each row finds its place by binary search.

Nothing that grows with the documents leaves the executors, and a length shared
by a third of all rows is only a long run.

Defined results: a null or empty text is the end id alone.  Null ids sort first.
Repeated rows are packed one by one (equal rows are interchangeable).  Extra
columns of the input do not appear in the result.  An empty table gives an empty
table.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import quoted, ship, stage

# bands of lengths that open sequences together; more bands come closer to one piece at a time
BANDS = 64
# letters whose lower case and composed form are the same in every Unicode version
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
SIMPLE = re.compile(rf"([{LETTERS}]*)([!-&(-/:-@\[-`{{-~]*)")


class WordTokenizer(dict):
    """Ids (little-endian uint32 bytes) of white-space separated chunks, remembered per worker process.

    The pre-tokeniser never joins characters across white space, so a text's ids
    are its chunks' ids in order.  A chunk of plain letters and marks goes
    straight to the BPE model, any other one through the whole tokeniser.  The
    memory is emptied when it holds ``most`` chunks.
    """

    def __init__(self, path: str, most: int = 800_000):
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.most = most
        specials = sorted(t.content.encode() for t in self.whole.get_added_tokens_decoder().values())
        self.special = re.compile(b"|".join(map(re.escape, specials)) or rb"(?!)")
        # printable stand-ins of the byte-level alphabet: visible Latin-1 bytes stand for themselves
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.stand_in = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        if (got := self.parts.get(part)) is None:
            shown = part if part.isascii() else "".join(map(self.stand_in.__getitem__, part.encode()))
            got = np.array([t.id for t in self.model.tokenize(shown)], "<u4").tobytes()
            if len(self.parts) >= self.most:
                self.parts.clear()
            self.parts[part] = got
        return got

    def __missing__(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        m = SIMPLE.fullmatch(text)
        if m and not self.special.search(chunk):
            word, marks = m.groups()
            got = (self._part(word.lower()) if word else b"") + (self._part(marks) if marks else b"")
        else:
            got = np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self) >= self.most:
            self.clear()
        self[chunk] = got
        return got

    def ids(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str, text_col: str,
           with_ids: bool) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, the ids."""
    id_type = docs.schema[id_col].dataType
    source = docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).cast("binary").alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(tokenizer)
        for batch in batches:
            at, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                data = tok.ids(text or b"") + end
                for k, a in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[a:a + 4 * capacity]
                    at.append(i)
                    piece.append(k)
                    start.append(a // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            cols = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = f"doc_id {id_type.simpleString()}, piece int, start long, length long, ids_crc32 long"
    return source.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def numbered(df: DataFrame) -> DataFrame:
    """Range-sorted rows with ``task`` and ``nth`` (the how-manieth row of its length in its task)."""
    order = ["length", "doc_id", "piece", "ids_crc32"]
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen, last = TaskContext.get().partitionId(), 0, -1
        for batch in batches:
            n = np.asarray(batch.column(batch.schema.names.index("length")))
            # rows are sorted: positions inside equal stretches, carried over batch borders
            cut = np.flatnonzero(np.diff(n, prepend=n[:1] - 1))
            nth = np.arange(len(n)) - np.repeat(cut, np.diff(np.append(cut, len(n))))
            if len(n) and n[0] == last:
                nth[:cut[1] if len(cut) > 1 else len(n)] += seen
            if len(n):
                last, seen = n[-1], int(nth[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(n), task, np.int64)),
                                              pa.array(nth.astype(np.int64))], [*batch.schema.names, "task", "nth"])

    schema = df.withColumns({"task": F.lit(0).cast("long"), "nth": F.lit(0).cast("long")}).schema
    return dealt.mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rounds of successor sweeps over runs; segments (length, first rank, number, first sequence, offset).

    ``counts`` has the number of pieces by length.  A free run is (gap, first
    sequence, number of sequences, tokens used).
    """
    placed = dict.fromkeys(counts, 0)
    segments, free, sequences = [], [], 0
    while left := sorted((n for n in counts if placed[n] < counts[n]), reverse=True):
        free.sort(reverse=True)
        widest = free[0][0] if free else 0
        # of the pieces beyond every gap the longest (a band of lengths of which equally many share a sequence)
        # open sequences; the others may still find gaps
        beyond = [n for n in left if n > widest]
        alike = [n for n in beyond if capacity // n == capacity // beyond[0] and n > beyond[0] - max(1, capacity // BANDS)]
        need = -(-sum(counts[n] - placed[n] for n in alike) // (capacity // beyond[0])) if beyond else 0
        if need:
            free.insert(0, (capacity, sequences, need, 0))
            sequences += need
        # the sweep: gaps are taken up from large to small, the last taken up is the smallest that fits
        open_gaps: list[tuple[int, int, int, int]] = []
        updated, i = [], 0
        for n in left:
            while i < len(free) and free[i][0] >= n:
                open_gaps.append(free[i])
                i += 1
            while open_gaps and placed[n] < counts[n]:
                gap, seq, many, used = open_gaps.pop()
                take = min(many, counts[n] - placed[n])
                segments.append((n, placed[n], take, seq, used))
                placed[n] += take
                if gap > n:
                    updated.append((gap - n, seq, take, used + n))
                if take < many:
                    open_gaps.append((gap, seq + take, many - take, used))
        least = min((n for n in counts if placed[n] < counts[n]), default=capacity + 1)
        free = [g for g in (*updated, *open_gaps, *free[i:]) if g[0] >= least]
    return segments


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces with their places: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    spark = docs.sparkSession
    ship(spark)
    found = stage(pieces(docs, tokenizer, capacity, end_id, id_col, text_col, with_ids), "pieces")
    rows = stage(numbered(found), "numbered")
    # at most (tasks + capacity) rows
    per_task = sorted((r["length"], r["task"], r["count"]) for r in rows.groupBy("task", "length").count().collect())
    counts: dict[int, int] = {}
    starts = []
    for n, task, c in per_task:
        starts.append((n, task, counts.get(n, 0)))
        counts[n] = counts.get(n, 0) + c
    segments = sorted(plan(counts, capacity))
    table = spark.sparkContext.broadcast((np.array(starts, np.int64).reshape(-1, 3),
                                          np.array(segments, np.int64).reshape(-1, 5)))
    out = [c for c in rows.columns if c not in ("task", "nth")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, seg = table.value
        first_at = {(n, t): s for n, t, s in first.tolist()}
        # (length, rank) as one sortable key: the segment is the last one that starts at or before it
        bits = np.int64(48)
        keys = (seg[:, 0] << bits) | seg[:, 1]
        for batch in batches:
            col = {c: np.asarray(batch.column(c)) for c in ("length", "task", "nth")}
            start = np.array([first_at[n, t] for n, t in zip(col["length"].tolist(), col["task"].tolist(), strict=True)],
                             np.int64)
            rank = start + col["nth"]
            at = np.searchsorted(keys, (col["length"] << bits) | rank, side="right") - 1
            hit = seg[at]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in out], pa.array(hit[:, 3] + rank - hit[:, 1]), pa.array(hit[:, 4])],
                [*out, "sequence_id", "offset"])

    schema = rows.select(*out).withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema
    return rows.mapInArrow(run, schema)

"""Toxicity by maximum-scoring segments (operator 1).

Words (A-Z lower-cased, runs of letters, digits and bytes beyond ASCII) carry
log-odds of the toxic against the clean class with an informative Dirichlet
prior: the prior of a word is its share in both classes plus half a count.
Words whose z-value reaches ``min_z`` keep their log-odds; all others weigh
nothing.  Every word also costs ``drift``, so a passage has to hold its marked
words close together and scores have a negative mean on clean text; a word that
repeats its predecessor only costs.

One linear scan per text finds *all* maximal scoring segments.  Their
significance follows extreme-value theory: in clean text of n words, segments of
score S or more are Poisson with mean ``K n exp(-lambda S)``, where lambda
solves ``E[exp(lambda * weight)] = 1`` over clean words and K is the observed
rate of segments in clean text.  The normalised scores ``lambda S - ln(K n)`` of
the significant segments (mean below ``alpha``) add up to a document's evidence x
(without one, the best segment gives x), and a logistic curve over x gives the
score.  A text without any segment scores the smoothed share of toxic rows
among such texts.

Fitting reads a bounded sample: at most ``max_labelled`` labelled texts, those
with the smallest digest of their id; the model therefore has a size bound of
its own and is sent to all tasks.  Three quarters of the sample (by text digest)
give the weights, the last quarter, which no weight has seen, gives lambda, K
and the curve.  Scoring covers every whole text.

Defined results: null and empty texts have no word and score as texts without a
segment.  Labels that are null, or contradict each other for one id, are left out.
Repeated rows score alike.  Without toxic or without clean training texts no
word is marked and every text gets the share of toxic rows (0 without rows).  Extra columns pass through;
an input column named like a result column is replaced.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import quoted, ship, without
from shelfcast.llm.decontamination import words

RESULT = ["score", "predicted", "passages"]


@dataclass
class ToxicityModel:
    weights: dict[bytes, float] = field(default_factory=dict)
    drift: float = 0.25
    lam: float = 1.0
    k: float = 1.0
    alpha: float = 0.01
    slope: float = 1.0
    offset: float = 0.0
    floor: float = 0.0

    def segments(self, text: bytes | None) -> tuple[int, list[tuple[int, int, float]]]:
        """(number of words, maximal scoring segments as (from, to, score))."""
        w = words(text)
        get = self.weights.get
        # a word said again at once adds nothing
        marked = [(i, s - self.drift) for i, s in ((i, get(x)) for i, x in enumerate(w)) if s is not None
                  and (i == 0 or w[i - 1] != w[i])]
        return len(w), maximal_segments(marked, self.drift)

    def evidence(self, text: bytes | None) -> tuple[float | None, list[tuple[int, int, float]]]:
        """(x, significant passages); x is None without any segment."""
        n, found = self.segments(text)
        if not found:
            return None, []
        normed = [(p, self.lam * p[2] - math.log(self.k * n)) for p in found]
        sure = [(p, x) for p, x in normed if x >= -math.log(self.alpha)]
        return (sum(x for _, x in sure) if sure else max(x for _, x in normed)), [p for p, _ in sure]

    def score(self, text: bytes | None) -> tuple[float, list[tuple[int, int, float]]]:
        """(probability, significant passages)."""
        x, sure = self.evidence(text)
        if x is None:
            return self.floor, sure
        z = min(max(self.slope * x + self.offset, -500.0), 500.0)
        return max(1 / (1 + math.exp(-z)), self.floor), sure


def maximal_segments(marked: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of a sequence in which position i of ``marked`` has its score and every
    other position scores ``-drift``; one pass, each candidate is merged at most once."""
    out: list[list[float]] = []  # candidates: from, to, sum before it, sum through it
    total, last = 0.0, -1
    for i, s in marked:
        total -= drift * (i - last - 1)
        last = i
        if s <= 0:
            total += s
            continue
        left, total = total, total + s
        new = [i, i + 1, left, total]
        # join back to the last candidate that starts lower, if that one ends lower too
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= new[2]:
                j = int(out[j][4])
            if j < 0 or out[j][3] >= new[3]:
                out.append([*new, j])
                break
            new = [out[j][0], new[1], out[j][2], new[3]]
            del out[j:]
    return [(int(a), int(b), high - low) for a, b, low, high, _ in out]


def training_rows(docs: DataFrame, labels: DataFrame, in_training, id_col: str, text_col: str, label_col: str,
                  max_labelled: int) -> DataFrame:
    """(text, y) of at most ``max_labelled`` labelled training texts."""
    agreed = (labels.where(quoted(label_col).isNotNull() & quoted(id_col).isNotNull())
              .groupBy(quoted(id_col).alias("id")).agg(F.min(quoted(label_col)).alias("y"), F.max(quoted(label_col)).alias("z"))
              .where("y = z").select("id", F.col("y").cast("int").alias("y")))
    some = agreed.where(in_training(F.col("id"))).orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    # at most max_labelled rows of two numbers: bounded
    return docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")).join(F.broadcast(some), "id") \
        .select("text", "y")


def fit(docs: DataFrame, labels: DataFrame, in_training, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_labelled: int = 20_000, prior: float = 1000.0, min_z: float = 3.3,
        drift: float = 0.25, alpha: float = 0.01) -> ToxicityModel:
    """Fit on the labelled texts whose id satisfies ``in_training`` (a function of a column)."""
    ship(docs.sparkSession)
    rows = training_rows(docs, labels, in_training, id_col, text_col, label_col, max_labelled)
    # copies of one text count once
    rows = rows.where("y in (0, 1)").select(F.coalesce(F.col("text"), F.lit("")).alias("text"), "y").distinct()
    rows = rows.withColumn("last", F.pmod(F.xxhash64("text"), F.lit(4)) == 0).persist()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # texts that hold a word, by class: a word counts once per text, so a text that repeats a word is one witness
        for batch in batches:
            seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[y].update(set(words(text)))
                seen[y][b""] += 1
            flat = [(w, n if y == 0 else 0, n if y == 1 else 0) for y, c in seen.items() for w, n in c.items()]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in flat], pa.binary()),
                                              pa.array([f[1] for f in flat], pa.int64()),
                                              pa.array([f[2] for f in flat], pa.int64())], ["w", "n0", "n1"])
    table = rows.where("not last").select(F.col("text").cast("binary"), "y") \
        .mapInArrow(count, "w binary, n0 long, n1 long").groupBy("w").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    table = table.persist()
    sums = table.where(F.length("w") > 0).agg(F.sum("n0"), F.sum("n1")).first()
    texts = table.where(F.length("w") == 0).select("n0", "n1").first()
    n0, n1 = (int(x or 0) for x in sums)
    d0, d1 = (int(x or 0) for x in texts) if texts else (0, 0)
    model = ToxicityModel(drift=drift, alpha=alpha)
    model.floor = (d1 + 0.5) / (d0 + d1 + 1) if d0 + d1 else 0.0
    if not n0 or not n1:
        rows.unpersist()
        table.unpersist()
        return model
    a = F.lit(prior) * (F.col("n0") + F.col("n1")) / (n0 + n1) + 0.5
    y1, y0 = F.col("n1") + a, F.col("n0") + a
    log_odds = F.log(y1 / (n1 + prior - y1)) - F.log(y0 / (n0 + prior - y0))
    # the sample bounds the number of words that reach this significance
    marked = table.where((F.length("w") > 0) & (F.col("n1") * n0 > F.col("n0") * n1)).select("w", log_odds.alias("s"), (
        log_odds / F.sqrt(1 / y1 + 1 / y0)).alias("z")).where(F.col("z") >= min_z).collect()
    model.weights = {bytes(r["w"]): float(r["s"]) for r in marked}
    _calibrate(rows, model)
    rows.unpersist()
    table.unpersist()
    return model


def _calibrate(rows: DataFrame, model: ToxicityModel) -> None:
    """Lambda, K, the curve and the floor from the last quarter (a few numbers per batch leave the tasks)."""
    weights = sorted(set(model.weights.values()))
    if not weights:
        return
    unseen = rows.where("last").select(F.col("text").cast("binary"), "y")

    def clean_stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, hits, segs = 0, Counter(), 0
            for text in batch.column(0).to_pylist():
                w = words(text)
                n += len(w)
                hits.update(s for s in map(model.weights.get, w) if s is not None)
                segs += len(model.segments(text)[1])
            keys = [("words", n), ("segments", segs), *((repr(s), c) for s, c in hits.items())]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in keys]), pa.array([c for _, c in keys], pa.int64())],
                                             ["k", "n"])
    found = {r["k"]: r["n"] for r in unseen.where("y = 0").mapInArrow(
        clean_stats, "k string, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()}
    n = found.get("words", 0) + 1
    # half a count over all weights: a marked word is rare in clean text, not impossible
    share = {s: (found.get(repr(s), 0) + 0.5 / len(weights)) / n for s in weights}

    def mean(lam: float) -> float:
        rest = 1 - sum(share.values())
        return rest * math.exp(-lam * model.drift) + sum(q * math.exp(lam * (s - model.drift)) for s, q in share.items())
    hi = 1e-6
    while mean(hi) < 1 and hi < 50:
        hi *= 2
    lo = hi / 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if mean(mid) < 1 else (lo, mid)
    model.lam = lo
    least = max(min(weights) - model.drift, 0.0)
    model.k = max((found.get("segments", 0) + 0.5) / (n * math.exp(-model.lam * least)), 1e-12)

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = Counter()
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = model.evidence(text)[0]
                c[None if x is None else round(2 * min(max(x, -60.0), 60.0)), y] += 1
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in c], pa.int32()), pa.array([k[1] for k in c], pa.int32()),
                                              pa.array(list(c.values()), pa.int64())], ["x2", "y", "n"])
    # at most 2 * 242 rows
    seen = unseen.mapInArrow(evidence, "x2 int, y int, n long").groupBy("x2", "y").agg(F.sum("n").alias("n")).collect()
    none = {y: sum(r["n"] for r in seen if r["x2"] is None and r["y"] == y) for y in (0, 1)}
    model.floor = (none[1] + 0.5) / (none[0] + none[1] + 1)
    some = [(r["x2"] / 2, r["y"], r["n"]) for r in seen if r["x2"] is not None]
    # one prior text of each class at the far ends keeps the curve rising and finite
    x, y, n = (np.array(c, float) for c in zip(*some, (-10.0, 0, 1), (10.0, 1, 1), strict=True))
    model.slope, model.offset = logistic(x, y, n)


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope (not negative) and offset of a logistic curve, by Newton's method with a small ridge."""
    beta = np.zeros(2)
    a = np.stack((x, np.ones_like(x)), axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        grad = a.T @ (n * (y - p)) - ridge * beta
        hess = (a * (n * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ a + ridge * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(beta[0]), 0.0), float(beta[1])


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` plus ``score``, ``predicted`` and ``passages`` (word spans [from, to) and scores)."""
    ship(docs.sparkSession)
    keep = without(docs, RESULT)
    base = docs.select(*[quoted(c) for c in keep])
    at = [c.lower() for c in keep].index(text_col.lower())
    sent = docs.sparkSession.sparkContext.broadcast(model)
    passage = T.StructType([T.StructField("from", T.LongType()), T.StructField("to", T.LongType()),
                            T.StructField("score", T.DoubleType())])
    schema = T.StructType(base.schema.fields + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
                                                T.StructField("passages", T.ArrayType(passage))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            got = [m.score(t) for t in batch.column(at).cast(pa.binary()).to_pylist()]
            cols = [pa.array([p for p, _ in got], pa.float64()), pa.array([int(p >= threshold) for p, _ in got], pa.int32()),
                    pa.array([[{"from": a, "to": b, "score": s} for a, b, s in x] for _, x in got],
                             pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64()), ("score", pa.float64())])))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], schema.names)
    return base.mapInArrow(run, schema)

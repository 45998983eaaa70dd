"""Toxicity segments and the Katz model against brute force and held-out rows."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from helpers import CLASHES, documents, edge_texts, random_text
from pyspark.sql import functions as F

from shelfcast.llm import katz
from shelfcast.llm.common import in_training
from shelfcast.llm.toxicity import ToxicityModel, fit, maximal_segments, score_toxicity


def brute_segments(scores):
    """All maximal scoring segments by definition: the best one, then left and right of it."""
    best = None
    for a in range(len(scores)):
        total = 0.0
        for b in range(a, len(scores)):
            total += scores[b]
            if total > 1e-9 and (best is None or total > best[2] + 1e-9):
                best = (a, b + 1, total)
    if best is None:
        return []
    left = brute_segments(scores[:best[0]])
    right = [(a + best[1], b + best[1], s) for a, b, s in brute_segments(scores[best[1]:])]
    return [*left, best, *right]


def test_all_maximal_segments_are_found():
    rng = random.Random(0)
    for _ in range(300):
        n, drift = rng.randint(0, 25), rng.choice([0.37, 1.13])
        marked = [(i, rng.uniform(0.2, 3)) for i in range(n) if rng.random() < 0.4]
        scores = [-drift] * n
        for i, s in marked:
            scores[i] = s
        got, want = maximal_segments(marked, drift), brute_segments(scores)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2] for g in got], [w[2] for w in want])


def test_toxic_passages_are_found_and_long_clean_texts_left_alone():
    m = ToxicityModel(weights={b"bad": 6.0, b"vile": 5.0}, drift=0.25, lam=1.0, k=0.001, slope=1.0, offset=-2.0, floor=0.02)
    long_text = b"plain words " * 2000
    p, found = m.score(long_text + b"bad and vile, BAD! " + long_text)
    assert p > 0.9 and [(a, b) for a, b, _ in found] == [(4000, 4004)]
    assert m.score(long_text) == (0.02, []) and m.score(None) == (0.02, []) and m.score(b"") == (0.02, [])


def test_held_out_toxicity(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = fit(docs, labels, lambda c: in_training(c, 4, 2))
    rows = score_toxicity(docs, model).join(labels, "doc_id").where(~in_training(F.col("doc_id"), 4, 2)).collect()
    good = [(r.score, r.predicted, r.toxic) for r in rows]
    assert all(0 <= s <= 1 and p == int(s >= 0.3) for s, p, _ in good)
    assert sum(p for _, p, y in good if y == 0) <= 0.02 * len(good)
    toxic = [s for s, _, y in good if y]
    clean = [s for s, _, y in good if not y]
    auc = np.mean([(t > c) + 0.5 * (t == c) for t in toxic for c in clean])
    assert auc > 0.8


def test_toxicity_edges(spark):
    texts = edge_texts() + ["vile bad words"] * 6 + ["good plain words"] * 30
    docs = documents(spark, texts, clashes=True)
    labels = spark.createDataFrame([(i, int("vile" in (t or ""))) for i, t in enumerate(texts)] + [(None, 1), (2, None), (3, 1)],
                                   "doc_id long, toxic int")
    got = score_toxicity(docs, fit(docs, labels, lambda c: F.lit(True))).orderBy("doc_id").collect()
    assert len(got) == len(texts) and got[0]["_d"] == CLASHES["_d"]
    assert got[0].score == got[1].score
    empty = fit(docs, labels.limit(0), lambda c: F.lit(True))
    assert empty.weights == {} and {r.score for r in score_toxicity(docs, empty).collect()} == {0.0}
    assert score_toxicity(docs.limit(0), empty).count() == 0


class BruteKatz:
    """The same model with dictionaries."""

    def __init__(self, texts):
        self.uni, self.bi, self.hist = Counter(), Counter(), Counter()
        for t in texts:
            w = tokens(t)
            self.uni.update(w)
            for h, x in zip(["\r", *w], w, strict=False):
                self.bi[h, x] += 1
                self.hist[h] += 1
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        of = lambda c: tuple(sum(x == r for x in c.values()) for r in range(1, katz.K + 2))
        self.d1, self.d2 = katz.discounts(of(self.uni)), katz.discounts(of(self.bi))
        self.unknown = 1 - sum(self.star(c, self.d1) for c in self.uni.values()) / self.n if self.n else 1.0

    @staticmethod
    def star(r, d):
        return d[r - 1] * r if r <= katz.K else r - katz.TAIL

    def p1(self, w):
        return self.star(self.uni[w], self.d1) / self.n if self.uni[w] else self.unknown

    def p2(self, h, w):
        if not self.hist[h]:
            return self.p1(w)
        if self.bi[h, w]:
            return self.star(self.bi[h, w], self.d2) / self.hist[h]
        seen = [x for g, x in self.bi if g == h]
        return (1 - sum(self.p2(h, x) for x in seen)) / (1 - sum(map(self.p1, seen))) * self.p1(w)

    def score(self, text):
        w = tokens(text)
        return sum(math.log10(self.p2(h, x)) for h, x in zip(["\r", *w], w, strict=False))


def tokens(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + ["\n"]


@pytest.mark.parametrize("block", [40, 4_000_000])
def test_katz_matches_brute_force(spark, monkeypatch, block):
    rng = random.Random(block)
    texts = [random_text(rng, rng.randint(0, 40)) for _ in range(50)] + [None, "", "one", "the the the the the the the the"] * 2
    docs = documents(spark, texts, clashes=True).repartition(3)
    monkeypatch.setattr(katz, "BLOCK_TOKENS", block)
    monkeypatch.setattr(katz, "BUCKET_ENTRIES", 64 if block == 40 else 1 << 21)
    train = in_training(F.col("doc_id"), 7, 2)
    got = katz.katz_scores(docs, train)
    rows = {r.doc_id: r for r in got.scores.collect()}
    flags = {r.doc_id: r.y for r in docs.select("doc_id", train.alias("y")).collect()}
    model = BruteKatz([t for i, t in enumerate(texts) if flags[i]])
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        r, w = rows[i], tokens(t)
        assert (r.train, r.n_tokens, r.train_tokens) == (flags[i], len(w), model.n)
        assert r.n_known == sum(model.uni[x] > 0 for x in w)
        assert r.base_score == pytest.approx(sum(math.log10((model.uni[x] + 1) / (model.n + model.v + 1)) for x in w))
        assert r.score == pytest.approx(model.score(t)), t
    # exactly normalised after any history, unseen words as one class
    for h in ["\r", *list(model.uni)[:10], "never seen"]:
        assert sum(model.p2(h, x) for x in [*model.uni, "\x00unseen"]) == pytest.approx(1, abs=1e-9)
    # the stored tables hold every count once
    n = sum(katz.unpack(r["data"]).sum() for r in got.pairs.collect())
    assert n == sum(model.bi.values())
    assert sum(len(katz.unpack(r["data"])) for r in got.words.collect()) == model.v


def test_katz_edges(spark):
    texts = [t[:3000] if t else t for t in edge_texts()]
    none = katz.katz_scores(documents(spark, texts), F.lit(False)).scores.collect()
    assert {r.train_tokens for r in none} == {0} and {r.score for r in none} == {0.0}
    assert katz.katz_scores(documents(spark, []), F.lit(True)).scores.count() == 0
    same = katz.katz_scores(documents(spark, ["a b"] * 4, [None, 1, 1, 2]), F.lit(True)).scores.collect()
    assert len(same) == 4 and len({r.score for r in same}) == 1


def test_discounts():
    d = katz.discounts((1000, 400, 220, 140, 100, 75))
    assert all(0 < a < b < 1 for a, b in zip(d, d[1:], strict=False))
    assert (katz.discounts((0, 0, 0, 0, 0, 0)) > 0).all() and (katz.discounts((5, 0, 0, 0, 0, 0)) < 1).all()

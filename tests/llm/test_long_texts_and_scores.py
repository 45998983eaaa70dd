"""The toxicity fit and score in plain Python; very long texts in packing and language-model scoring."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
import xxhash
from helpers import documents
from pyspark.sql import functions as F
from test_search_pack_urls import TOKENIZER, check_packing
from test_toxicity_katz import BruteKatz, brute_segments, tokens
from tokenizers import Tokenizer

from shelfcast.llm import katz
from shelfcast.llm.packing import pack
from shelfcast.llm.toxicity import fit, score_toxicity


def words(text):
    return regex.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", regex.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_fit(rows, prior=1000.0, min_z=3.3, drift=0.25):
    """(weights, lambda, K, floor, curve points) from (text, y) rows."""
    rows = sorted({(t or "", y) for t, y in rows})
    last = {t: xxhash.xxh64_intdigest(t.encode(), 42) % 4 == 0 for t, _ in rows}
    n = [Counter(), Counter()]
    for t, y in rows:
        if not last[t]:
            n[y].update(set(words(t)))
    total = [sum(c.values()) for c in n]
    weights = {}
    for w in n[1]:
        a = prior * (n[0][w] + n[1][w]) / sum(total) + 0.5
        y1, y0 = n[1][w] + a, n[0][w] + a
        s = math.log(y1 / (total[1] + prior - y1)) - math.log(y0 / (total[0] + prior - y0))
        if n[1][w] * total[0] > n[0][w] * total[1] and s / math.sqrt(1 / y1 + 1 / y0) >= min_z:
            weights[w] = s

    def segments(text):
        w = words(text)
        scores = [weights[x] - drift if x in weights and (i == 0 or w[i - 1] != x) else -drift for i, x in enumerate(w)]
        return len(w), brute_segments(scores)
    clean = [t for t, y in rows if last[t] and y == 0]
    m = sum(len(words(t)) for t in clean) + 1
    hits = Counter(weights[x] for t in clean for x in words(t) if x in weights)
    levels = sorted(set(weights.values()))
    share = {s: (hits[s] + 0.5 / len(levels)) / m for s in levels}
    mean = lambda lam: (1 - sum(share.values())) * math.exp(-lam * drift) + sum(q * math.exp(lam * (s - drift)) for s, q in share.items())
    lo, hi = 1e-6, 50.0           # below 1 at first, above 1 beyond the root
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if mean(mid) < 1 else (lo, mid)
    found = sum(len(segments(t)[1]) for t in clean)
    k = max((found + 0.5) / (m * math.exp(-lo * max(min(levels) - drift, 0))), 1e-12)

    def evidence(text, alpha=0.01):
        size, got = segments(text)
        if not got:
            return None
        x = [lo * s - math.log(k * size) for _, _, s in got]
        sure = [v for v in x if v >= -math.log(alpha)]
        return sum(sure) if sure else max(x)
    unseen = [(evidence(t), y) for t, y in rows if last[t]]
    none = [sum(x is None and y == c for x, y in unseen) for c in (0, 1)]
    points = [(round(2 * min(max(x, -60.0), 60.0)) / 2, y) for x, y in unseen if x is not None] + [(-10.0, 0), (10.0, 1)]
    return weights, lo, k, (none[1] + 0.5) / (sum(none) + 1), points, evidence


def test_fit_and_score_match_plain_python(spark):
    rng = random.Random(12)
    plain = [f"w{i}" for i in range(60)] + ["Ünder", "über,", "12", "don't"]
    bad = ["VILE", "bad", "awful", "nasty"]

    def text(y):
        w = [rng.choice(plain) for _ in range(rng.randint(3, 18))]
        if y or rng.random() < 0.04:
            at = rng.randrange(len(w))
            w[at:at] = [rng.choice(bad) for _ in range(rng.randint(1, 4))]
        return rng.choice([" ", "  ", ", ", "\n"]).join(w)
    labelled = [(text(y), y) for y in [0] * 500 + [1] * 200]
    texts = [t for t, _ in labelled] + [None, "", "bad bad bad bad", "bad VILE awful", "…"]
    docs = documents(spark, texts, clashes=True)
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(labelled)], "doc_id long, toxic int")
    model = fit(docs, labels, lambda c: F.lit(True))
    weights, lam, k, floor, points, evidence = brute_fit(labelled)
    assert {w.decode(): pytest.approx(s) for w, s in model.weights.items()} == weights and set(weights) >= {"vile", "bad"}
    assert model.lam == pytest.approx(lam, rel=1e-6) and model.k == pytest.approx(k, rel=1e-5) and model.floor == pytest.approx(floor)
    # the curve is where the penalised likelihood is flat
    x, y = (np.array(c, float) for c in zip(*points))
    p = 1 / (1 + np.exp(-(model.slope * x + model.offset)))
    assert abs(((y - p) * x).sum() - 1e-3 * model.slope) < 1e-4 and abs((y - p).sum() - 1e-3 * model.offset) < 1e-4
    for r, t in zip(score_toxicity(docs, model).orderBy("doc_id").collect(), texts, strict=True):
        e = evidence(t)
        want = floor if e is None else max(1 / (1 + math.exp(-(model.slope * e + model.offset))), floor)
        assert r.score == pytest.approx(want, abs=1e-6) and r.predicted == int(r.score >= 0.3), t


def long_text(words_in_all, seed):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(1, 9))) for _ in range(900)]
    return " ".join(rng.choice(vocabulary) + rng.choice(["", "", ".", ", naïve", "\n"]) for _ in range(words_in_all))


def test_packing_of_very_long_texts(spark):
    texts = [long_text(120_000, 1), "short", long_text(40_000, 2), None, "x" * 300_000]
    whole = Tokenizer.from_file(TOKENIZER)
    expected = []
    for i, t in enumerate(texts):
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 1]
        for piece, a in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[a:a + 4096], "<u4")
            expected.append((str(i), piece, a, len(part), zlib.crc32(part.tobytes())))
    got = pack(documents(spark, texts), TOKENIZER).collect()
    assert check_packing(got, expected, 4096) <= sum(e[3] for e in expected) // 4096 + 2
    assert max(r.piece for r in got) > 25


def test_scores_of_very_long_texts(spark, monkeypatch):
    monkeypatch.setattr(katz, "BLOCK_TOKENS", 5000)    # a long text is a block of its own, beyond the bound
    texts = [long_text(60_000, 3), "a b c", long_text(9_000, 4), "", "a b a b"]
    got = {r.doc_id: r for r in katz.katz_scores(documents(spark, texts), F.col("doc_id") != 2).scores.collect()}
    model = BruteKatz([t for i, t in enumerate(texts) if i != 2])
    after = {}
    for h, x in model.bi:
        after.setdefault(h, []).append(x)

    def p2(h, w):
        if not model.hist[h]:
            return model.p1(w)
        if model.bi[h, w]:
            return model.star(model.bi[h, w], model.d2) / model.hist[h]
        if h not in left:
            left[h] = (1 - sum(p2(h, x) for x in after[h])) / (1 - sum(map(model.p1, after[h])))
        return left[h] * model.p1(w)
    left = {}
    for i, t in enumerate(texts):
        w = tokens(t)
        assert got[i].n_tokens == len(w) and got[i].train_tokens == model.n
        assert got[i].score == pytest.approx(sum(math.log10(p2(h, x)) for h, x in zip(["\r", *w], w, strict=False)), rel=1e-9)

"""Whitening, tokenizer alignment and source mixing against brute force."""

import hashlib
import heapq
import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from helpers import CLASHES, documents, edge_texts, random_text
from pyspark.sql import functions as F

from shelfcast.llm.alignment import Encoders, token_alignment
from shelfcast.llm.mixing import mix, sainte_lague, taken_words
from shelfcast.llm.queries import queries, tokenizer_path
from shelfcast.llm.whitening import decompose, fit_whitening, pivoted_cholesky, whiten, whitened_components

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>"


# ---- whitening ------------------------------------------------------------------------------------------------------

def brute_whitening(rows, dims, most=16):
    """Integer rows by id (list), n, exact sums, covariance over the distinct rows."""
    keep = [(i, [math.floor(64 * c) + 1000000 for c in v]) for i, v in rows
            if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in keep})
    n = len(fit)
    sums = [sum(c) for c in zip(*fit)]
    cov = [[Fraction(sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in fit), n**3) for j in range(dims)] for i in range(dims)]
    return keep, n, sums, np.array([[float(v) for v in r] for r in cov])


def check_whitening(spark, rows, dims, rank=None):
    out = whitened_components(fit_whitening(spark.createDataFrame(rows, VECTORS))).collect()
    keep, n, sums, cov = brute_whitening(rows, dims)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(16, dims if rank is None else rank)
    assert len(out) == len(keep) * k
    got = defaultdict(list)
    for r in out:
        assert r["n"] == n and r["identity_error"] <= 1e-4
        assert abs(r["explained"] - values[r["component"] - 1] / np.trace(cov)) <= 1e-4 * r["explained"]
        got[r["vec_id"]].append(r)
    signs = {}
    for i, x in keep:
        assert {r["deviation"] for r in got[i] if r["vec_id"] == i} >= {sum((n * a - s) ** 2 for a, s in zip(x, sums))}
        if Counter(v for v, _ in keep)[i] > 1:
            continue
        for r in got[i]:
            c = r["component"] - 1
            want = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)]) @ vectors[:, c] / math.sqrt(values[c])
            if abs(want) > 1e-6:
                assert signs.setdefault(c, np.sign(want * r["whitened"])) == np.sign(want * r["whitened"])
                assert abs(abs(want) - abs(r["whitened"])) < 1e-6 * max(1, abs(want))


def test_whitening_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    spread = rng.normal(size=(120, 6)) * np.array([9, 7, 5, 3, 2, 1])
    rows = [(i, v.tolist()) for i, v in enumerate(spread)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(50)]                    # copies count once in the fit list
    rows += [(2000, None), (2001, [1.0] * 5 + [None]), (2002, [math.nan] * 6), (2003, [1.0] * 5 + [math.inf]), (2004, []),
             (2005, [1.0, 2.0]), (None, [0.5] * 6), (7, rows[7][1]), (7, rows[8][1])]
    check_whitening(spark, rows, 6)


def test_whitening_of_dependent_and_constant_dimensions(spark):
    rng = np.random.default_rng(6)
    base = rng.integers(-200, 200, size=(60, 3)) / 64
    rows = [(i, [*v, *v[:2], 2.0]) for i, v in enumerate(base.tolist())]
    check_whitening(spark, rows, 6, rank=3)


def test_whitening_of_large_entries_is_exact(spark):
    rng = np.random.default_rng(7)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(40, 3)) * [1e6, 1e3, 1.0] + [1e9, 0, 5])]
    keep, n, sums, cov = brute_whitening(rows, 3)
    model = fit_whitening(spark.createDataFrame(rows, VECTORS))
    assert np.allclose(model.values, np.sort(np.linalg.eigvalsh(cov))[::-1], rtol=1e-9) and model.identity_error < 1e-6
    for r in whiten(model).collect():
        want = sum((n * a - s) ** 2 for a, s in zip(dict(keep)[r["vec_id"]], sums))
        assert r["deviation"] == (want if want < 2**63 else None)


def test_whitening_without_variance(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3):
        model = fit_whitening(spark.createDataFrame(rows, VECTORS))
        out = whitened_components(model)
        assert out.count() == 0
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    wide = spark.createDataFrame([(1, [1.0, 2.0], "x", 3), (2, [4.0, 1.0], "y", 4)], "vec_id long, embedding array<float>, n string, dims int")
    assert whitened_components(fit_whitening(wide)).count() == 2  # two points span one component


def test_decomposition():
    rng = np.random.default_rng(8)
    for d, r in ((1, 1), (2, 2), (7, 4), (16, 16), (33, 20)):
        a = rng.normal(size=(d, r)) @ np.diag(0.5 ** np.arange(r))  # eigenvalues over many magnitudes
        s = (a @ a.T).astype(np.longdouble) if r == d else np.round(rng.normal(size=(d, r)) * 9).astype(np.longdouble)
        s = s if r == d else s @ s.T
        low, order = pivoted_cholesky(s)
        assert low.shape[1] == r and np.allclose((low @ low.T).astype(float), s[np.ix_(order, order)].astype(float))
        vectors, values = decompose(s, d)
        assert np.allclose((vectors.T @ vectors).astype(float), np.eye(r), atol=1e-13)
        assert np.all(np.diff(values) <= 0) and np.allclose((vectors * values @ vectors.T).astype(float), s.astype(float))


def test_whitening_query(spark):
    got = queries()["op11_whitening"](spark, SF).toPandas()
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    keep, n, sums, cov = brute_whitening(rows, 64)
    assert len(got) == 16 * len(keep) and set(got["n"]) == {n}
    values, vectors = np.linalg.eigh(cov)
    x = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums)] for _, v in keep])
    z = x @ vectors[:, ::-1][:, :16] / np.sqrt(values[::-1][:16])
    w = got.pivot(index="vec_id", columns="component", values="whitened").loc[[i for i, _ in keep]].to_numpy()
    assert np.allclose(np.abs(w), np.abs(z), atol=1e-9) and got["identity_error"].max() < 1e-9


# ---- alignment ------------------------------------------------------------------------------------------------------

BYTE, PIECE = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def brute_alignment(texts):
    enc, docs, links_of = Encoders(BYTE, PIECE), [], []
    for text in texts:
        a = enc.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = enc.b.encode(text) if text else []
        spans = []
        for ids, side in ((a, enc.side_a), (b, enc.side_b)):
            at, out = 0, []
            for i in ids:
                data = side.data[i].as_py()
                out.append((at, at + len(data), i, data))
                at += len(data)
            spans.append(out)
        if not text or any(b"".join(s[3] for s in side) != (" " + text).encode() for side in spans):
            docs.append((0, 0, 0, ""))
            links_of.append([])
            continue
        cuts = sorted({s[1] for s in spans[0]} & {s[1] for s in spans[1]})
        parts, start = [], 0
        for end in cuts:
            parts.append("|".join(",".join(str(s[2]) for s in side if start < s[1] <= end) for side in spans))
            start = end
        links, j = [], 0
        for s in spans[0]:
            while spans[1][j][1] <= s[0]:
                j += 1
            links += [(s[2], t[2]) for t in spans[1][j:j + s[1] - s[0] + 1] if t[0] < s[1] and t[1] > s[0]]
        docs.append((len(a), len(b), len(cuts), hashlib.sha256(";".join(parts).encode()).hexdigest()))
        links_of.append(links)
    counts = Counter(p for links in links_of for p in set(links))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return [(d[0], d[1], d[2], len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), d[3])
            for d, links in zip(docs, links_of)]


def alignment_rows(df):
    return sorted(map(tuple, df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()),
                  key=str)


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(3)
    texts = edge_texts()
    long = next(t for t in texts if t and len(t) > 10_000)
    texts[texts.index(long)] = long[:40_000]
    return [*texts, "a▁b", "a  b\n\n c\t", "<s> </s> <unk> <0x41> <|endoftext|>", "\x00x", "é\r\n", "ﬁ ½ 한국어 🙂👍🏽", "▁", " ",
            *[random_text(rng, rng.randint(1, 60)) for _ in range(30)]]


def test_alignment_matches_brute_force(spark, odd_texts):
    docs = documents(spark, odd_texts, [*range(len(odd_texts) - 2), None, 0], clashes=True).repartition(5)
    want = sorted(((i, *r) for i, r in zip([*range(len(odd_texts) - 2), None, 0], brute_alignment(odd_texts))), key=str)
    assert alignment_rows(token_alignment(docs, BYTE, PIECE)) == want
    # most pairs beyond the broadcast bound: the shuffle join serves them
    for hot in (0, 3, 40):
        assert alignment_rows(token_alignment(docs, BYTE, PIECE, hot=hot)) == want


def test_alignment_of_nothing(spark):
    out = token_alignment(documents(spark, []), BYTE, PIECE)
    assert out.count() == 0 and out.columns[0] == "doc_id"
    assert alignment_rows(token_alignment(documents(spark, [None, ""]), BYTE, PIECE)) == [(i, 0, 0, 0, 0, 0, 0, "") for i in range(2)]


def test_alignment_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(((r[0], *x) for r, x in zip(rows, brute_alignment([r[1] for r in rows]))), key=str)
    assert alignment_rows(queries()["op12_token_alignment"](spark, SF)) == want


# ---- mixing ---------------------------------------------------------------------------------------------------------

def brute_targets(sizes, weights=(5, 2, 1), budget=1.5, most=2):
    """Target by source: share by weight, cut at the bound, share the excess again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, full = Fraction(budget) * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in full]
        rest = left - sum(most * sizes[s] for s in full)
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if share[s] > most * sizes[s]}
        if not above:
            return {s: float(share.get(s, most * sizes[s])) for s in order}
        full |= above


def brute_seats(v, cap, total):
    heap = [(-x, i, 0) for i, x in enumerate(v) if x > 0 and cap[i] > 0]
    heapq.heapify(heap)
    out = [0] * len(v)
    for _ in range(total):
        _, i, k = heapq.heappop(heap)
        out[i] += 1
        if k + 1 < cap[i]:
            heapq.heappush(heap, (-v[i] / (2 * k + 3), i, k + 1))
    return out


def test_seats_match_the_highest_quotients(spark):
    rng = random.Random(9)
    for trial in range(6):
        n = rng.randint(1, 40)
        v = [rng.choice([0.0, rng.uniform(0, 30), 7.0, 7.0, 21.0]) for _ in range(n)]
        cap = [rng.randint(1, 40) for _ in range(n)]
        total = rng.randint(0, sum(c for x, c in zip(v, cap) if x > 0))
        df = spark.createDataFrame(list(zip(range(n), v, cap)), "i long, v double, cap long")
        got = {r["i"]: r["quota"] for r in sainte_lague(df, "v", "cap", total, [F.col("i")]).collect()}
        want = brute_seats(v, cap, total)
        assert sum(got.values()) == total
        # equal quotients may go to any of their holders: as many seats for each value and bound
        by = lambda q: sorted((round(v[i], 9), cap[i], q[i]) for i in range(n))
        lowest = lambda q: sorted(v[i] / (2 * k + 1) for i in range(n) for k in range(q[i]))
        assert np.allclose(lowest(got), lowest(want)) and (trial or len(by(got)) == n)


def test_taken_words():
    rng = np.random.default_rng(4)
    for _ in range(50):
        sizes = rng.integers(1, 40, rng.integers(1, 30))
        blocks = max(1, round(sizes.sum() / 16))
        quota = int(rng.integers(0, 2 * blocks + 1))
        taken = taken_words(sizes, blocks, quota, 11)
        assert (taken >= 0).all() and (taken <= 2 * sizes).all()
        assert abs(taken.sum() - quota * sizes.sum() / blocks) <= blocks  # blocks differ by a word at most
        if quota == 2 * blocks:
            assert (taken == 2 * sizes).all()


def _mix_rows(df, **kw):
    return sorted((tuple(r) for r in mix(df, **kw).collect()), key=str)


def test_mix_of_odd_rows(spark):
    rng = random.Random(2)
    sources = ["b", "a", None, "", "é", "Z", "hot", "hot", "hot", "no words"]
    rows = []
    for i, t in enumerate([*edge_texts(), *[random_text(rng, rng.randint(1, 90)) for _ in range(300)]]):
        rows.append((i, t, rng.choice(sources[:-1])))
    rows += [(5000, None, "no words"), (5001, " \n", "no words"), (None, "x y z", "a")] + [(6000, "same text here " * 5, "a")] * 20
    clashes = {c: F.lit(str(v)) for c, v in CLASHES.items()} | {c: F.lit("?") for c in ("size", "h", "rank", "shard", "taken", "key")}
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(clashes)
    blank = " \t\n\x0b\x0c\r"
    count = lambda t: len([w for w in (t or "").translate({ord(c): " " for c in blank}).split(" ") if w])
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += count(t)
    targets = brute_targets(sizes)
    got = _mix_rows(df, block_words=8, shard_words=500)
    assert len(got) == len(rows)
    assert sorted(((r[0], r[1], r[2]) for r in got), key=str) == sorted(((i, s, count(t)) for i, t, s in rows), key=str)
    taken, shards = defaultdict(int), defaultdict(int)
    for _, source, size, source_size, target, words in got:
        assert source_size == sizes[source] and abs(target - targets[source]) < 1e-6 * max(1, target)
        assert 0 <= words <= 2 * size
        taken[source] += words
    for s, n in sizes.items():
        shards[s] = 1 + (max(n, 1) - 1) // 500
        assert abs(taken[s] - targets[s]) <= 10 * shards[s] + 0.02 * n
    assert _mix_rows(df.repartition(7), block_words=8, shard_words=500) == got
    assert _mix_rows(df, block_words=8, shard_words=500, seed=1) != got


def test_mix_of_nothing(spark):
    schema = "doc_id long, text string, source string"
    empty = mix(spark.createDataFrame([], schema))
    assert empty.count() == 0 and empty.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
    assert _mix_rows(spark.createDataFrame([(1, None, None), (2, "", "a")], schema)) == [(1, None, 0, 0, 0.0, 0), (2, "a", 0, 0, 0.0, 0)]
    assert _mix_rows(spark.createDataFrame([(1, "one", "a")], schema)) in ([(1, "a", 1, 1, 1.5, 1)], [(1, "a", 1, 1, 1.5, 2)])


def test_mix_query(spark):
    got = queries()["op13_mixing"](spark, SF).collect()
    rows = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len(got) == rows
    taken = defaultdict(int)
    for r in got:
        taken[r["source"]] += r["taken"]
        assert r["taken"] <= 2 * r["size"]
    targets = brute_targets({r["source"]: r["source_size"] for r in got})
    for r in got:
        assert abs(r["target"] - targets[r["source"]]) < 1e-6 * r["target"]
        assert abs(taken[r["source"]] - r["target"]) <= 64
    assert abs(sum(targets.values()) - 1.5 * sum({r["source"]: r["source_size"] for r in got}.values())) < 1e-3

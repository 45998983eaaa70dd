"""Line windows, unit hashing and SimHash against brute force."""

import json
import random
from collections import defaultdict

import numpy as np
import xxhash
from helpers import CLASHES, documents, edge_texts, random_text
from pyspark.sql import functions as F

from shelfcast.llm.common import join_by_key
from shelfcast.llm.line_dedup import line_dedup
from shelfcast.llm.queries import queries
from shelfcast.llm.simhash import components, simhash_components, simhash_dedup
from shelfcast.llm.substring_dedup import substring_dedup

BLANK = " \t\n\x0b\x0c\r"


def _rank(rows):
    return sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))


def brute_lines(rows, size=3):
    """{row number: text}; ids must be distinct."""
    worded, first = {}, {}
    for r in _rank(rows):
        text = rows[r][1]
        if text is None:
            continue
        worded[r] = [(i, x.strip(BLANK)) for i, x in enumerate(text.split("\n")) if x.strip(BLANK)]
        for w in range(len(worded[r]) - size + 1):
            first.setdefault(tuple(x for _, x in worded[r][w:w + size]), (r, w))
    out = {}
    for r, (_, text) in enumerate(rows):
        gone = set()
        for w in range(len(worded.get(r, [])) - size + 1):
            f = first[tuple(x for _, x in worded[r][w:w + size])]
            if f != (r, w):
                gone |= {worded[r][w + j][0] for j in range(size) if f[0] != r or w + j > f[1] + size - 1}
        out[r] = text if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
    return out


def _corpus(seed, n):
    rng = random.Random(seed)
    lines = [random_text(rng, rng.randint(1, 14), lines=False).strip(BLANK) for _ in range(12)]
    return [(i, "\n".join(rng.choice(lines) + rng.choice(["", " ", ""]) for _ in range(rng.randint(0, 9)))) for i in range(n)]


def test_line_windows_match_brute_force(spark):
    for seed in range(3):
        rows = _corpus(seed, 40) + [(None, "a\nb\nc\nd"), (100, "a\nb\nc\nd"), (101, None), (102, "")]
        got = line_dedup(documents(spark, [t for _, t in rows], [i for i, _ in rows])).select("doc_id", "text").collect()
        want = brute_lines(rows)
        assert sorted(((r[0] is None, r[0], r[1]) for r in got), key=str) == \
            sorted(((i is None, i, want[k]) for k, (i, _) in enumerate(rows)), key=str)


def test_a_large_class_is_dealt_to_slices(spark, monkeypatch):
    # fingerprints of one class: 16 bits of 64, four in each part; many tiles, of which a task takes two
    from shelfcast.llm import simhash
    monkeypatch.setattr(simhash, "SLICE", 2)
    rng = random.Random(6)
    fps = set()
    while len(fps) < 300:
        base = sum(1 << (16 * p + b) for p in range(4) for b in rng.sample(range(16), 4))
        fps.add(base)
        if rng.random() < 0.4:  # a neighbour at two bits in the same class
            p = rng.randrange(4)
            on = [b for b in range(16) if base >> (16 * p + b) & 1]
            off = [b for b in range(16) if not base >> (16 * p + b) & 1]
            fps.add(base ^ 1 << (16 * p + rng.choice(on)) ^ 1 << (16 * p + rng.choice(off)))
    signed = [f - (1 << 64) if f >> 63 else f for f in sorted(fps)]
    got = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), "fp", 2, tile=8).collect()
    root = {r["node"]: r["root"] for r in components(spark.createDataFrame([(r["u"], r["v"]) for r in got], "u long, v long")).collect()}
    want = brute_components([f % (1 << 64) for f in signed], signed, 2)
    assert [root.get(f, f) for f in signed] == want and len(set(want)) < 300


def test_first_occurrence_stays_whole(spark):
    got = line_dedup(documents(spark, ["x\nx\nx\nx\nx", "x\nx\nx"])).orderBy("doc_id").collect()
    assert [(r.text, r.n_lines, r.n_removed) for r in got] == [("x\nx\nx", 5, 2), ("", 3, 3)]


def test_dedup_edges(spark):
    texts = edge_texts()
    for op in (line_dedup, substring_dedup):
        out = op(documents(spark, texts, clashes=True))
        rows = out.orderBy("doc_id").collect()
        assert len(rows) == len(texts)
        assert rows[0].text is None and rows[1].text == ""
        assert [r["_d"] for r in rows] == [CLASHES["_d"]] * len(texts)
        assert op(documents(spark, [])).count() == 0
        # repeated rows: one document, one result
        twice = op(documents(spark, ["a b\nc d\ne f"] * 3, [7, 7, 7])).select("text").distinct().collect()
        assert [r.text for r in twice] == ["a b\nc d\ne f"]
    assert [r.text for r in substring_dedup(documents(spark, [None, "", " ", "x " * 20, "X " * 20], [None, 1, 2, None, 3]))
            .orderBy(F.col("doc_id").isNull(), "doc_id", "text").collect()] == ["", " ", "X " * 20, None, ""]


def brute_passages(texts, least, sep="\n"):
    """[(text, spans)]: every repeat is known, those in runs of at least ``least`` words go (blank units between do not count)."""
    seen, out = set(), []
    for text in texts:
        parts = text.split(sep)
        keys = [" ".join(p.split()).lower() for p in parts]
        repeat = []
        for k in keys:
            repeat.append(k != "" and k in seen)
            seen.add(k)
        gone, run = set(), []
        for u, k in [*enumerate(keys), (len(keys), "end")]:
            if u < len(keys) and repeat[u]:
                run.append(u)
            elif k != "":
                if sum(len(keys[r].split()) for r in run) >= least:
                    gone |= set(run)
                run = []
        spans, at = [], 0
        for u, p in enumerate(parts):
            if u in gone:
                spans.append((at, len(p)))
            at += len(p) + len(sep)
        out.append((sep.join(p for u, p in enumerate(parts) if u not in gone), spans))
    return out


def test_passages_match_brute_force(spark):
    rng = random.Random(5)
    lines = [" ".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 15))) for _ in range(14)]
    texts = ["\n".join(rng.choice([*lines, *(p.upper() + "  " for p in lines), *(f"own {i} {j}" for j in range(9)), "", " \t"])
                       for _ in range(rng.randint(1, 700 if i == 3 else 9))) for i in range(40)]
    for least in (1, 8, 15, 10**6):
        got = substring_dedup(documents(spark, texts), min_run_words=least).orderBy("doc_id").collect()
        for r, (text, spans) in zip(got, brute_passages(texts, least), strict=True):
            assert r.text == text and [(s.start, s.length) for s in r.spans] == spans and r.n_removed == len(spans)
    assert all(not s for _, s in brute_passages(texts, 10**6)) and any(s for _, s in brute_passages(texts, 15))


def test_short_lines_go_inside_a_passage_only(spark, tmp_path):
    long_line = " ".join(f"w{i}" for i in range(12))
    texts = [f"Menu\nOne two three\n\n{long_line}\nown a", f"Menu\none  two THREE\n\n{long_line}\nown b", "Menu\n\nown c"]
    documents(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries()["op9_substring_dedup"](spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [r.text for r in got] == [texts[0], "\nown b", texts[2]]
    assert [(r.n_units, r.n_removed) for r in got] == [(5, 0), (5, 3), (3, 0)]
    assert json.loads(got[1].spans) == [{"start": 0, "length": 4}, {"start": 5, "length": 14},
                                        {"start": 21, "length": len(long_line)}]
    assert [(r.text, spans) for r, spans in zip(got, [json.loads(r.spans) for r in got])] == [
        (t, [{"start": a, "length": n} for a, n in s]) for t, s in brute_passages(texts, 15)]


def test_paragraph_units(spark):
    p = " ".join(f"w{i}" for i in range(60))
    got = substring_dedup(documents(spark, [f"{p}\n\nown text", f"intro\n\n{p}"]), unit="paragraph").orderBy("doc_id").collect()
    assert [r.text for r in got] == [f"{p}\n\nown text", "intro"]


def brute_fingerprint(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, ids, radius):
    group = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = defaultdict(list)
    for g, i in zip(group, ids, strict=True):
        if i is not None:
            least[g].append(i)
    return [min(least[g]) if least[g] else None for g in group]


def test_simhash_matches_brute_force(spark):
    rng = random.Random(9)
    texts = [random_text(rng, rng.randint(1, 60)) for _ in range(60)]
    for t in list(texts[:25]):
        w = t.split(" ")
        w[rng.randrange(len(w))] = "changed"
        texts += [" ".join(w), t]
    texts += edge_texts()
    ids = list(range(len(texts)))
    ids[3], ids[10] = None, 11  # a null and a repeated id
    for radius in (2, 5):
        fps = [brute_fingerprint(t, 3) for t in texts]
        want = sorted(((i, f"{f:016x}", c) for i, f, c in zip(ids, fps, brute_components(fps, ids, radius), strict=True)), key=str)
        got = simhash_components(documents(spark, texts, ids, clashes=True), radius=radius, tile=4)
        assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()), key=str) == want
        assert "_d" in got.columns and "text" not in got.columns


def test_simhash_dedup_keeps_one_of_each(spark):
    texts = ["same text here for all of us", "same text here for all of us", "another quite different text", None, "", "x"]
    got = simhash_dedup(documents(spark, [*texts, texts[0]], [4, 2, 5, 9, 8, None, 2], clashes=True))
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(
        [(2, texts[1]), (5, texts[2]), (8, ""), (None, "x")], key=str)
    assert simhash_dedup(documents(spark, [])).count() == 0


def test_components_on_paths_and_stars(spark):
    rng = random.Random(3)
    path = list(range(1, 200))
    rng.shuffle(path)
    edges = list(zip(path, path[1:])) + [(1000, i) for i in range(1001, 1200)] + [(5000, 5000), (-7, 6000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = dict.fromkeys(path, 1) | dict.fromkeys(range(1000, 1200), 1000) | {-7: -7, 6000: -7}
    assert got == want


def test_join_by_key_serves_hot_and_rare_keys(spark):
    left = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).cast("long").alias("k"))
    right = left.groupBy("k").agg(F.count("*").alias("n")).withColumn("value", F.col("k") * 10).where("k <> 13")
    got = join_by_key(left, right, ["k"], ["id"], "n", 5000, hot=10)
    rows = got.collect()
    assert len(rows) == 5000
    assert all(r.value == (None if r.k == 13 else r.k * 10) for r in rows)


def test_bits_need_over_half():
    # two shingles that disagree in a bit leave it zero
    from shelfcast.llm.simhash import fingerprint
    h = [xxhash.xxh64_intdigest(g, 42) for g in (b"a b c", b"b c d")]
    assert fingerprint(b"A b c\nd", 3) == h[0] & h[1]
    assert np.uint64(fingerprint(b"", 3)) == 0

"""Decontamination, packing and the url filter against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import CLASHES, documents, edge_texts, random_text
from tokenizers import Tokenizer

from shelfcast.llm.decontamination import WuManber, decontaminate
from shelfcast.llm.packing import WordTokenizer, pack, plan
from shelfcast.llm.queries import URL_RULES
from shelfcast.llm.url_filter import BASE, ORDER, Rule, filter_urls, log_probabilities

NOT_WORD = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def item_words(text):
    return [w for w in NOT_WORD.split(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def brute_hits(text, bench, window):
    words, hit, items = item_words(text), set(), set()
    for item, t in bench:
        b = item_words(t)
        for i in range(max(1, len(b) - window + 1) if b else 0):
            p = b[i:i + window]
            for j in range(len(words) - len(p) + 1):
                if words[j:j + len(p)] == p:
                    hit |= set(range(j, j + len(p)))
                    items.add(item)
    return len(words), hit, items


def test_decontamination_matches_brute_force(spark):
    rng = random.Random(2)
    bench = [(i, random_text(rng, rng.choice([1, 2, 4, 5, 9, 14]))) for i in range(25)] + [(30, None), (31, ""), (32, "$$$"), (5, "x y")]
    bench += [(40, bench[7][1]), (41, "one")]
    texts = [random_text(rng, rng.randint(0, 60)) for _ in range(30)]
    for i in range(20):
        t = rng.choice(bench)[1] or ""
        texts.append(f"{random_text(rng, 5)} {t.upper().replace(' ', ', ')} {random_text(rng, 5)}")
    texts += edge_texts()
    table = spark.createDataFrame(bench, "item_id long, text string")
    for patterns in (200_000, 7):  # one block, and many
        got = decontaminate(documents(spark, texts, clashes=True), table, window=4, max_patterns=patterns).orderBy("doc_id").collect()
        for r, t in zip(got, texts, strict=True):
            n, hit, items = brute_hits(t, bench, 4)
            names = ",".join(sorted(map(str, items)))
            assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, len(hit), len(items), bool(hit)), t
            assert r.items_sha256 == hashlib.sha256(names.encode()).hexdigest()
            assert {i for s in r.hit_spans for i in range(s["from"], s["to"])} == hit
            assert r["_d"] == CLASHES["_d"]


def test_blocks_are_broadcast_one_at_a_time(spark, monkeypatch):
    live, most, made = set(), [0], [0]
    real = type(spark.sparkContext).broadcast

    def broadcast(self, value):
        out = real(self, value)
        key, made[0] = made[0], made[0] + 1
        live.add(key)
        most[0] = max(most[0], len(live))
        assert sum(map(len, value.values())) <= 4
        gone = out.destroy
        monkeypatch.setattr(out, "destroy", lambda *a, **b: (live.discard(key), gone(*a, **b)), raising=False)
        return out
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", broadcast)
    # one pattern of five items does not fit into a block of four pairs
    bench = [(i, "the same words") for i in range(5)] + [(10 + i, f"other text {i}") for i in range(5)]
    texts = ["say the same words, other text 3", "nothing here", None, "other text 0 other text 4 the same words"]
    got = decontaminate(documents(spark, texts, clashes=True), spark.createDataFrame(bench, "item_id long, text string"), window=3,
                        max_patterns=4).orderBy("doc_id").collect()
    assert made[0] == 3 and most[0] == 1 and not live
    for r, t in zip(got, texts, strict=True):
        n, hit, items = brute_hits(t, bench, 3)
        assert (r.n_words, r.n_hit, r.n_items) == (n, len(hit), len(items))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def test_decontamination_with_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate(documents(spark, ["a b", None]), none).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in got] == [(2, 0, False), (0, 0, False)]
    assert decontaminate(documents(spark, []), spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0


def test_wu_manber_finds_overlapping_occurrences():
    m = WuManber([(b" a a ", frozenset([1])), (b" a a a b ", frozenset([2]))])
    assert sorted(h[:2] for h in m.search(b" a a a b a a ")) == [(0, 5), (0, 9), (2, 7), (8, 13)]


TOKENIZER = str(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(TOKENIZER)


def test_word_tokens_equal_the_whole_text(whole):
    rng = random.Random(4)
    tok = WordTokenizer(TOKENIZER, most=50)
    texts = [random_text(rng, 80) for _ in range(40)] + [t for t in edge_texts() if t] + [
        "it's they're I'M don't 'tis ''s x's", "<|endoftext|> a<|startoftext|>b <|endof", "ÀÉÎÕÜ ß ﬁ İstanbul ΣΑΣ ς e\u0301 \u00a0x\u2003y z\x85w",
        "A.B,C!!D??... (x) [y] {z} a_b a-b 12345 ½ ² ٣", "日本語テキスト русский ёж", "a\u200db \ufeffc", "ª º µ × ÷ Ð ð Þ þ"]
    for t in texts:
        assert np.frombuffer(tok.ids(t.encode()), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, t


def check_packing(rows, expected, capacity):
    """All pieces there with their ids; every sequence gapless from 0 and within the capacity."""
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(expected)
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_packing_keeps_every_token(spark, whole):
    rng = random.Random(6)
    texts = [random_text(rng, int(rng.paretovariate(0.8) * 4)) for _ in range(120)] + edge_texts() + ["one two"] * 40
    texts = [t if t is None or len(t) < 20000 else t[:20000] for t in texts]
    ids = [None if i == 3 else i // 2 for i in range(len(texts))]
    for capacity in (64, 4096):
        expected = []
        for i, t in zip(ids, texts, strict=True):
            tokens = [*whole.encode(t or "", add_special_tokens=False).ids, 1]
            for k, a in enumerate(range(0, len(tokens), capacity)):
                part = np.array(tokens[a:a + capacity], "<u4")
                expected.append((str(i), k, a, len(part), zlib.crc32(part.tobytes())))
        got = pack(documents(spark, texts, ids, clashes=True), TOKENIZER, capacity=capacity, with_ids=True).collect()
        assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)
        n = check_packing(got, expected, capacity)
        assert n <= best_fit(sorted((e[3] for e in expected), reverse=True), capacity) * 1.01 + 1
    assert pack(documents(spark, []), TOKENIZER).count() == 0


def best_fit(lengths, capacity):
    """Number of sequences of sequential best-fit decreasing."""
    gaps = []
    for n in lengths:
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


def test_plan_is_as_good_as_sequential_best_fit():
    rng = random.Random(8)
    cases = [[rng.randint(1, 100) for _ in range(400)], [rng.randint(1, 12) for _ in range(600)], [51] * 30 + [49] * 30 + [3] * 50,
             [1] * 1000, [100] * 5, [rng.choice([34, 33, 32, 20, 7]) for _ in range(500)], [min(100, int(rng.paretovariate(0.7))) for _ in range(800)]]
    for lengths in cases:
        counts = {n: lengths.count(n) for n in set(lengths)}
        segments = plan(counts, 100)
        placed, used = defaultdict(int), defaultdict(int)
        for n, rank, take, seq, at in segments:
            placed[n] += take
            for s in range(seq, seq + take):
                assert used[s] == at  # gapless, in order
                used[s] += n
        assert placed == counts and max(used.values()) <= 100
        assert len(used) <= best_fit(sorted(lengths, reverse=True), 100) * 1.01 + 1


def brute_rule(host, path, rules):
    best = None
    for r in rules:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path) and (
                best is None or (-len(r.text), r.text) < (-len(best.text), best.text)):
            best = r
    return best


def test_url_rules_and_parts(spark):
    urls = ["http://A.Example.ORG/es/1?x=/y", "https://example.org/en/12", "https://example.org/en/2", "https://badexample.org/es/3",
            "http://x.com/fr/9#a?b", "http://com/de/1", "ftp://h.net", "no scheme /es/", None, "", "://", "http://org", "http://org/",
            "http://x.org?q=http://y.com/fr/", "http://ÜX.org/ä\nb", "http://u:p@x.com:80/de/?", "a://b://c/d"]
    df = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(urls)], "page_id long, url string, Host string, _url string")
    got = filter_urls(df, URL_RULES).orderBy("page_id").collect()
    for r, u in zip(got, urls, strict=True):
        rest = (u or "").split("://", 1)[1] if "://" in (u or "") else ""
        host = re.sub("[A-Z]", lambda m: m[0].lower(), re.split(r"[/?#]", rest, maxsplit=1)[0])
        tail = rest[len(host):]
        path = re.split(r"[?#]", tail, maxsplit=1)[0]
        rule = brute_rule(host, path, URL_RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule.text if rule else None), u
        assert r.verdict == (rule.action if rule else r.verdict) and r.verdict in ("allow", "block")
        assert r["_url"] == "p"
    assert got[8].verdict == got[9].verdict == "block"
    assert filter_urls(df.limit(0), URL_RULES).count() == 0


def test_models_are_normalised_and_separate(spark):
    rng = random.Random(1)
    counts = np.zeros(BASE ** (ORDER + 1), np.int64)
    counts[[rng.randrange(len(counts)) for _ in range(5000)]] = 3
    assert np.allclose(np.exp(log_probabilities(counts)).reshape(-1, BASE).sum(axis=1), 1)
    rules = [Rule("allow", "good.net", "/"), Rule("block", "spam.net", "/")]
    name = lambda: "".join(rng.choice("abcdef") for _ in range(5))
    rows = [(i, f"https://good.net/{name()}/page") for i in range(80)] + [(i, f"https://spam.net/buy-{name()}?ref=1") for i in range(80)]
    rows += [(i, f"https://other.net/{name()}/page") for i in range(200, 220)]
    rows += [(i, f"https://third.net/buy-{name()}?ref=1") for i in range(300, 320)]
    got = {r.page_id: r.verdict for r in filter_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).where("rule is null").collect()}
    assert all(got[i] == "allow" for i in range(200, 220)) and all(got[i] == "block" for i in range(300, 320))

"""Line rules and url ratios once more in plain Python, over whole test tables."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
import xxhash
from helpers import documents, edge_texts, random_text

from shelfcast.llm import quality_rules as Q
from shelfcast.llm import url_filter as U
from shelfcast.llm.queries import URL_RULES, queries
from shelfcast.llm.url_filter import Rule, filter_urls

SF = "/root/testdata/sf0.001"
BLANK = "\t\n\x0b\x0c\r "


# ---- quality rules --------------------------------------------------------------------------------------------------

def java(pattern):
    r"""``\W`` and ``\s`` of the engine are ASCII."""
    return regex.compile(pattern.replace(r"\W", "[^a-zA-Z0-9_]").replace(r"\s", r"[ \t\n\x0b\f\r]").replace(r"\S", r"[^ \t\n\x0b\f\r]"))


MENU, BOILERPLATE, PHRASE, MARK = (java(p) for p in (Q.MENU, Q.BOILERPLATE, Q.PHRASE, Q.MARK))


def words(text):
    return [w for w in regex.split(f"[{BLANK}]+", text) if w]


def line_passes(line, rules):
    n = len(words(line))
    if not n:
        return True
    count = lambda p: len(regex.findall(p, line))
    if n > rules.heading_words and (not MARK.search(line) or not regex.search(r"\p{Ll}", line) and regex.search(r"\p{Lu}", line)):
        return False
    if PHRASE.search(line):
        return False
    if count(r"[#*$%&]{2,}") > n * rules.max_burst_ratio or count(r"[#*$%&|<>]") > n * rules.max_symbol_ratio:
        return False
    cells = count(Q.CELL)
    if cells > 1 and cells > n * rules.max_cell_ratio or count(r"[!?]{2,}") > n * rules.max_burst_ratio:
        return False
    return not (n <= rules.boilerplate_words and (MENU.search(line) or BOILERPLATE.search(line)))


def brute_rules(text, rules=None):
    rules = rules or Q.LineRules()
    text = text or ""
    w, lines = words(text), text.split("\n")
    k = rules.window
    windows = Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    covered = {j for i in range(len(w) - k + 1) if windows[tuple(w[i:i + k])] > 1 for j in range(i, i + k)}
    seen, kept, dup = set(), [], 0
    for line in lines:
        again = bool(words(line)) and line in seen
        dup += again
        seen.add(line)
        if not again and line_passes(line, rules):
            kept.append(line)
    chars = lambda t: sum(c not in BLANK for c in t)
    clean = "\n".join(kept)
    failed = len(w) < rules.min_words or 100 * len(covered) > rules.max_repeat_percent * len(w)
    return (clean, len(w), chars(text), len(regex.findall(Q.SYMBOLS, text)), dup, len(covered), len(lines) - len(kept), chars(clean),
            failed, not failed and chars(clean) >= rules.min_kept_ratio * chars(text))


def check_rules(df, texts):
    names = ["clean_text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines_removed", "kept_chars",
             "base_failed", "kept"]
    for r, t in zip(df.orderBy("doc_id").select(*names).collect(), texts, strict=True):
        assert tuple(r) == brute_rules(t), t[:300]


def test_line_rules_match_brute_force(spark):
    rng = random.Random(4)
    lines = ["Home | About us | Contact", "© 2020 All rights reserved", "WHY IS ALL OF THIS IN CAPITALS, IT SEEMS, AND SO MUCH LONGER THAN A HEADING?",
             "buy now buy now buy now buy now and more", "## ** $$ %%", "a | b | c | d", "what?? why!! how?? no", "x % y # z * w $ v & u",
             "यह एक लंबी पंक्ति है जिसमें बारह से अधिक शब्द हैं और अपना ही पूर्ण विराम है।", "Սա երկար տող է որը ունի տասներկու բառից ավելի և ավարտվում է իր նշանով այստեղ հիմա։",
             "no mark in this line of more than twelve words so it is some list of things", "A sentence with a mark, as there should be one in every line of text."]
    texts = ["\n".join(rng.choice([*lines, random_text(rng, rng.randint(1, 25), lines=False), "", "\t"]) for _ in range(rng.randint(1, 12)))
             for _ in range(150)] + [t or "" for t in edge_texts() if t is None or len(t) < 20_000]
    check_rules(Q.quality_rules(documents(spark, texts)), texts)


def test_whole_test_table_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check_rules(Q.quality_rules(docs), [r["text"] for r in docs.orderBy("doc_id").collect()])


def test_marks_of_other_scripts_end_a_sentence(spark):
    long = " ".join(f"शब्द{chr(0x905 + i)}" for i in range(14))
    texts = [long + mark for mark in "।॥։؟۔።។།။。！？፧"] + [long]
    check_rules(Q.quality_rules(documents(spark, texts)), texts)
    assert all(line_passes(t, Q.LineRules()) for t in texts[:-1]) and not line_passes(texts[-1], Q.LineRules())


def test_windows_are_powers_of_two(spark):
    for window in (0, 3, 6, 12):
        with pytest.raises(ValueError):
            Q.quality_rules(documents(spark, ["a"]), rules=Q.LineRules(window=window))


# ---- urls -----------------------------------------------------------------------------------------------------------

def symbols(url):
    out = []
    for b in url.encode():
        c = chr(b).lower() if b < 128 else ""
        c = "0" if c.isdigit() else c
        out.append(U.ALPHABET.index(c) + 1 if c and c in U.ALPHABET else U.OTHER)
    return [0] * U.ORDER + out + [0]


class Markov:
    """Witten-Bell blending, from dictionaries."""

    def __init__(self, urls):
        self.counts = [defaultdict(Counter) for _ in range(U.ORDER + 1)]
        for u in urls:
            s = symbols(u)
            for i in range(U.ORDER, len(s)):
                for k in range(U.ORDER + 1):
                    self.counts[k][tuple(s[i - k:i])][s[i]] += 1
        self.known = {}

    def p(self, context, symbol):
        if (context, symbol) not in self.known:
            lower = 1 / U.BASE if not context else self.p(context[1:], symbol)
            got = self.counts[len(context)].get(context)
            if got is None and not context:
                out = lower
            elif got is None:
                out = lower
            else:
                total = sum(got.values())
                out = (got[symbol] + len(got) * self.p_below(context, symbol)) / (total + len(got))
            self.known[context, symbol] = out
        return self.known[context, symbol]

    def p_below(self, context, symbol):
        return 1 / U.BASE if not context else self.p(context[1:], symbol)

    def logs(self, url):
        s = symbols(url)
        return [math.log(self.p(tuple(s[i - U.ORDER:i]), s[i])) for i in range(U.ORDER, len(s))]


def brute_urls(urls, rules):
    """(llr, verdict, whether it is sure) of each url."""
    def decided(u):
        rest = (u or "").split("://", 1)[1] if "://" in (u or "") else ""
        host = regex.split(r"[/?#]", rest, maxsplit=1)[0]
        path = regex.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = regex.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fits, key=lambda r: len(r.text)).action if fits else None
    actions = [decided(u) for u in urls]
    held = [xxhash.xxh64_intdigest((u or "").encode(), 42) % U.HELD_OUT == 0 for u in urls]
    train = {a: [u for u, x, h in zip(urls, actions, held) if x == a and not h and u] for a in ("allow", "block")}
    if not all(train.values()):
        return None
    good, bad = Markov(train["allow"]), Markov(train["block"])
    llr = [sum(a - b for a, b in zip(good.logs(u), bad.logs(u))) / len(good.logs(u)) if u else 0.0 for u in urls]
    bins = [min(max(math.floor((x + U.SPAN) / (2 * U.SPAN) * U.BINS), 0), U.BINS - 1) for x in llr]
    own = [i for i, (a, h) in enumerate(zip(actions, held)) if a and h]
    if len({actions[i] for i in own}) < 2:
        own = [i for i, a in enumerate(actions) if a]
    ok, no = (np.array([bins[i] for i in own if actions[i] == a]) for a in ("allow", "block"))
    errors = np.array([(ok < c).mean() + (no >= c).mean() for c in range(U.BINS + 1)])
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    cut = (best[0] + best[-1]) / 2 / U.BINS * 2 * U.SPAN - U.SPAN
    return [(x, a or ("allow" if u and x >= cut else "block"), a is not None or not u or abs(x - cut) > 1e-4)
            for u, x, a in zip(urls, llr, actions)]


def check_urls(rows, urls, rules):
    sure = 0
    for r, (llr, verdict, certain) in zip(rows, brute_urls(urls, rules), strict=True):
        assert abs(r["llr"] - llr) < 1e-4
        if certain:
            assert r["verdict"] == verdict
            sure += 1
    assert sure >= 0.99 * len(urls)


def test_url_ratio_matches_brute_force(spark):
    rng = random.Random(3)
    name = lambda: "".join(rng.choice("abcdefxyz09-") for _ in range(rng.randint(1, 9)))
    rules = [Rule("allow", "good.net", "/"), Rule("block", "spam.net", "/"), Rule("block", "good.net", "/ads/")]
    urls = [f"https://{name()}.good.net/{name()}/{name()}.html" for _ in range(60)] + [f"http://spam.net/buy-{name()}?ref={name()}" for _ in range(60)]
    urls += [f"https://good.net/ads/{name()}" for _ in range(9)] + [f"https://{name()}.org/{name()}" for _ in range(60)]
    urls += [None, "", "no scheme", "https://x.org/" + "long/" * 3000, "https://GOOD.net/A", "http://ü.net/é", urls[0], urls[0], urls[200 % len(urls)]]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").repartition(4)
    check_urls(filter_urls(df, rules).orderBy("page_id").collect(), urls, rules)


def test_registered_url_query_matches_brute_force(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").select("page_id", "url").collect()
    got = {r["page_id"]: r for r in queries()["op3_url_filter"](spark, SF).collect()}
    check_urls([got[p["page_id"]] for p in pages], [p["url"] for p in pages], URL_RULES)


def test_urls_that_tie_and_one_kind_only(spark):
    rules = [Rule("allow", "good.net", "/"), Rule("block", "spam.net", "/")]
    schema = "page_id long, url string"
    same = [(i, "https://other.net/page") for i in range(5)] + [(10 + i, f"https://good.net/{i}") for i in range(30)] \
        + [(50 + i, f"https://spam.net/{i}") for i in range(30)]
    got = filter_urls(spark.createDataFrame(same, schema), rules).where("page_id < 5").select("llr", "verdict").distinct().collect()
    assert len(got) == 1
    only = filter_urls(spark.createDataFrame(same[:20], schema), rules).orderBy("page_id").collect()
    assert {r["verdict"] for r in only} == {"allow"} and {r["llr"] for r in only} == {0.0}

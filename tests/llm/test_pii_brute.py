"""Surrogates written once more in plain Python: the query's texts must be equal, character by character."""

import hashlib
import math
import string
from collections import Counter, defaultdict

import regex
from helpers import documents, edge_texts

from shelfcast.llm import pii
from shelfcast.llm.pii import surrogates
from shelfcast.llm.queries import queries

SF = "/root/testdata/sf0.001"
DIGITS, ALPHABETS = "0123456789", [*pii.LOWER.values(), *pii.UPPER.values()]


def java(pattern):
    """The engine's digits, blanks and word borders are ASCII; letters are Unicode."""
    out, inside = [], False
    i = 0
    while i < len(pattern):
        two = pattern[i:i + 2]
        if two == r"\d":
            out.append("0-9" if inside else "[0-9]")
        elif two == r"\D":
            out.append("[^0-9]")
        elif two == r"\s":
            out.append(r" \t\n\x0b\f\r" if inside else r"[ \t\n\x0b\f\r]")
        elif two[0] == "\\":
            out.append(two)
        else:
            inside = (inside or two[0] == "[") and two[0] != "]"
            out.append(two[0])
            i -= 1
        i += 2
    return regex.compile("".join(out))


ANY, HINT, CODE = java(pii.ANY), java(pii.HINT), java(pii.CODE)
TITLED = {g: java(rf"^(?:{'|'.join(t)})\.? ") for g, t in (("m", pii.MALE), ("f", pii.FEMALE), ("n", pii.NEUTRAL))}


def kind_of(e):
    if regex.search(r"^[^ \t\n\x0b\f\r=:]+@", e):
        return "email"
    if java(r"[=:]\s*[\"']").search(e):
        return "secret"
    for g, pattern in TITLED.items():
        if pattern.search(e):
            return "person_" + g
    if java(rf"^{pii.OCTET}(?:\.{pii.OCTET}){{3}}$").search(e):
        return "ip"
    if java(r"^\d{3}-\d{2}-\d{4}$").search(e):
        return "ssn"
    return "card" if java(r"^(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})$").search(e) else "phone"


def only_digits(s):
    return "".join(c for c in s if c in DIGITS)


def canonical(kind, e):
    if kind == "phone":
        return ("+" if e.startswith("+") else "") + only_digits(e)
    if kind in ("card", "ssn"):
        return only_digits(e)
    if kind == "secret":
        return regex.search(r"([A-Za-z0-9+/_=-]+)$", e)[1]
    if kind == "email":
        return e.lower()
    if kind.startswith("person"):
        return java(rf"^{pii.TITLE} ").sub("", e)
    return e


def is_hex(kind, norm):
    return kind == "secret" and bool(regex.fullmatch("[0-9a-f]+|[0-9A-F]+", norm))


def sha(*parts):
    return hashlib.sha256("\x1f".join(map(str, parts)).encode()).hexdigest()


def alphabet(c, hexadecimal):
    for letters in [DIGITS, *(["abcdef", "ABCDEF"] if hexadecimal else []), *ALPHABETS]:
        if c in letters:
            return letters
    return None


def luhn(digits):
    total = 0
    for i, c in enumerate(digits):
        v = int(c) * (2 if (len(digits) - i) % 2 == 0 else 1)
        total += v - 9 if v > 9 else v
    return total % 10


def drawn(key, kind, norm, attempt):
    blocks = [sha(key, kind, norm, attempt, b) for b in range(len(norm) // 32 + 1)]
    number = lambda i, n: int(blocks[i // 32][i % 32 * 2:i % 32 * 2 + 2], 16) % n
    h = is_hex(kind, norm)
    classed = "".join(c if not (a := alphabet(c, h)) else a[number(i, len(a))] for i, c in enumerate(norm))
    if kind == "email":
        cut = norm.rindex(".") + 1
        return classed[:cut] + norm[cut:]
    if kind == "ip":
        return ".".join(str(number(i, 223) + 1) for i in range(4))
    if kind == "card":
        return classed[:-1] + str((luhn(norm) - luhn(classed[:-1] + "0")) % 10)
    if kind == "phone":
        code = m[0] if (m := CODE.search(norm)) else ""
        return code + classed[len(code):]
    if kind.startswith("person") and " " in norm:
        gender = kind[-1] if kind != "person_n" else "mf"[number(31, 2)]
        names = pii.NAMES[script(norm), gender]
        return names[number(30, len(names))] + classed[len(norm.split(" ")[0]):]
    return classed


def script(norm):
    return "cyrillic" if regex.match(r"\p{Cyrillic}", norm) else "greek" if regex.match(r"\p{Greek}", norm) else "latin"


def cells(kind, norm):
    start = len(m[0]) if kind == "phone" and (m := CODE.search(norm)) else 0
    end = norm.rindex(".") + 1 if kind == "email" else len(norm)
    h, out = is_hex(kind, norm), []
    for i, c in enumerate(norm):
        a = alphabet(c, h) if start <= i < end else None
        out.append((c, a, pii.CLASSES.index(a) if a else -1))
    return out


def shape_of(part):
    return "\x1e".join(c if k < 0 else str(k) for c, _, k in part)


def permuted(key, kind, norm):
    part = cells(kind, norm)
    half = -(-len(part) // 2)
    sides = part[:half], part[half:]
    a, b = (math.prod(len(letters or "x") for _, letters, _ in s) for s in sides)
    if a * b < 2:
        return norm
    number = []
    for s in sides:
        v = 0
        for c, letters, _ in s:
            v = v * len(letters or "x") + (letters.index(c) if letters else 0)
        number.append(v)
    keyed = lambda *p: int(sha(key, "format", kind, shape_of(part), *p)[:12], 16)
    left, right = number

    def network(left, right, rounds, sign):
        for j in rounds:
            if j % 2 == 0:
                left = (left + sign * (keyed(j, right) % a)) % a
            else:
                right = (right + sign * (keyed(j, left) % b)) % b
        return left, right
    left, right = network(left, right, range(pii.ROUNDS), 1)
    at = (left * b + right + 1 + keyed("step") % (a * b - 1)) % (a * b)
    out = ""
    for s, v in zip(sides, network(at // b, at % b, range(pii.ROUNDS)[::-1], -1)):
        text = ""
        for c, letters, _ in reversed(s):
            text = (letters[v % len(letters)] if letters else c) + text
            v //= len(letters or "x")
        out += text
    return out


def room(kind, norm):
    part = cells(kind, norm)
    several = kind.startswith("person") and " " in norm
    rest = part[len(norm.split(" ")[0]):] if several else part
    bits = sum(math.log2(len(a)) for _, a, _ in rest if a)
    if several:
        return (script(norm), kind, shape_of(rest)), bits + math.log2(len(pii.NAMES[script(norm), "m"]))
    return shape_of(rest), bits


def settle(key, entities):
    """Surrogate by entity (kind, norm)."""
    family = lambda k: "person" if k.startswith("person") else k
    formats = defaultdict(list)
    for kind, norm in entities:
        if kind not in ("card", "ip"):
            shape, bits = room(kind, norm)
            formats[family(kind), shape, round(bits, 6)].append((kind, norm))
    full = {e for (_, _, bits), es in formats.items()
            if 0 < bits < 62 and len(es) + len({n for _, n in es}) > 0.75 * 2**bits + 0.01 for e in es}
    out = {e: permuted(key, *e) for e in full}
    left = sorted(set(entities) - full)
    occupied, attempt = {(family(k), n) for k, n in left}, 0
    while left:
        draws = {e: drawn(key, *e, attempt) for e in left}
        groups = defaultdict(list)
        for (k, n), s in draws.items():
            groups[family(k), s].append((n, k))
        losers = [(k, n) for (k, n), s in draws.items() if (family(k), s) in occupied or min(groups[family(k), s]) != (n, k)]
        for e in set(left) - set(losers):
            out[e] = draws[e]
            occupied.add((family(e[0]), draws[e]))
        left, attempt = losers, attempt + 1
    return out, attempt, len(full)


def rendered(kind, e, s):
    if kind in ("phone", "card", "ssn"):
        digits = iter(s.lstrip("+"))
        return "".join(next(digits) if c in DIGITS else c for c in e)
    if kind == "email":
        return s.upper() if e.upper() == e and e.lower() != e else s
    if kind == "secret":
        return regex.sub(r"[A-Za-z0-9+/_=-]+$", "", e) + s
    return java(rf"^({pii.TITLE} )").search(e)[1] + s if kind.startswith("person") else s


def brute(texts, key):
    found = [[(m[0], kind_of(m[0])) for m in ANY.finditer(t)] if t and HINT.search(t) else [] for t in texts]
    entities = {(k, canonical(k, e)) for es in found for e, k in es}
    table, rounds, full = settle(key, entities)
    out = []
    for t, es in zip(texts, found):
        todo = iter(es)

        def new(m):
            e, k = next(todo)
            return rendered(k, e, table[k, canonical(k, e)])
        out.append(ANY.sub(new, t) if es else t)
    return out, Counter(k for k, _ in entities), rounds, full


def texts_of(spark, texts, key):
    return [r.text for r in surrogates(documents(spark, texts), key).orderBy("doc_id").collect()]


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    got = {r["doc_id"]: r["text"] for r in queries()["op8_pii_surrogates"](spark, SF).collect()}
    want, kinds, _, _ = brute([r["text"] for r in rows], "public-example-key")
    assert len(kinds) >= 4
    assert [got[r["doc_id"]] for r in rows] == want


def test_odd_texts_equal_brute_force(spark):
    texts = [*edge_texts(), "Mr. Li Wu, Mrs Li Wu; Dr. Ána Õlivier-Strauß and г-жа Ольга Петрова, κύριος Νίκος Ψ. Dr Ng",
             'token = "deadBEEF12" secret: \'DEADBEEF99\' api_key="00ff00ff00ff" password = "x_y-z/9+AA=="',
             "a@b.co A@B.CO x.y_z@mail.test.org ß@é.de 123-45-6789 (555) 123-4567 555-123-4567 +385 12 34 +1 415 555 0123",
             "4539 1488 0343 6467 4539148803436467 10.0.0.1 255.255.255.255 256.1.1.1 1.2.3.4.5 +7 (495) 123-45-67",
             "mail " * 2000 + "end@of.text"]
    want, kinds, _, _ = brute(texts, "k")
    assert texts_of(spark, texts, "k") == want
    assert {"email", "secret", "ip", "phone", "card", "ssn", "person_m", "person_f", "person_n"} <= set(kinds)


def test_every_two_letter_name_gets_another_one(spark):
    names = [a + b for a in string.ascii_uppercase for b in string.ascii_lowercase]
    texts = [f"met Mr {n}." for n in names]
    want, _, rounds, full = brute(texts, "k")
    got = texts_of(spark, texts, "k")
    assert got == want and rounds == 0 and full == 676
    assert sorted(got) == sorted(texts) and all(a != b for a, b in zip(got, texts))


def test_losers_draw_again_until_all_are_distinct(spark):
    # 250 of 676 names, 3,000 of 10,000 numbers and 60 of 100: two formats with rounds, one that is permuted
    texts = [f"met {('Mr', 'Ms', 'Dr')[i % 3]} {chr(65 + i // 26)}{chr(97 + i % 26)}." for i in range(250)]
    texts += [f"call +49 {i // 100:02d} {i % 100:02d}" for i in range(3000)] + [f"call +3 85 {i:02d}" for i in range(60)]
    want, _, rounds, full = brute(texts, "k")
    got = texts_of(spark, texts, "k")
    assert got == want and 2 < rounds < 40 and full == 60
    assert len({t.split()[-1] for t in got[:250]}) == 250 and len(set(got[250:])) == 3060
    assert not set(got[250:3250]) & set(texts[250:3250])


def test_crowded_names_of_two_parts(spark):
    # 16 given names times 26 letters hold no 300 persons: they are permuted, given names too
    texts = [f"met Mr {chr(65 + i % 26)}{chr(97 + i // 26)}x {chr(65 + i // 12)}." for i in range(300)]
    want, _, _, _ = brute(texts, "k")
    got = texts_of(spark, texts, "k")
    assert got == want and len(set(got)) == len(set(texts))

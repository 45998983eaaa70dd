"""PII surrogates (operator 8), DataFrame functions only.

Entities (:data:`KINDS`) are found by one pattern per text, cut out and replaced
by surrogates of the same kind, format and script:

* an e-mail address keeps its separators, digits, number of labels and top
  domain; letters become letters of the same script and case;
* phone and card numbers keep their punctuation and length, a card number also
  whether its Luhn sum holds; a phone number keeps its country code, which the
  numbering plan (ITU E.164) tells from the digits, with or without separator;
* an IPv4 address stays one; a secret (``token = "..."``) keeps its length and,
  if it is hexadecimal, stays hexadecimal;
* a person after a title keeps the title (so the gender) and gets a given name of
  that gender and script; further names are replaced letter by letter.

A surrogate is a function of a secret key, the kind and the canonical entity
(SHA-256), so one entity has one surrogate in all documents and in all its
formats (coreference; a person known by titles of different gender counts as
different persons).  Collision checks keep distinct entities distinct: a draw is
settled unless it equals an entity that occurs in the corpus, a surrogate
settled before, or the draw of a smaller entity of its kind.  Only entities that lose
draw again, with the next attempt number, until none is left.  The checks compare
what is emitted: country codes are in place, and persons count as one kind
whatever their title.

A format (:func:`room`) is what an entity shares with all its surrogates, such as
the country code and length of a phone number.  While its entities and as many
surrogates fill at most three quarters of its values, one draw in four succeeds at
the least, so the number of rounds grows as the logarithm of the number of losers.  A fuller, *crowded*
format is not drawn but permuted: each entity moves to another value by a keyed
permutation without fixed points (:func:`permuted`), so its surrogates differ by construction,
without a round.  What cannot hold there: that surrogates avoid all entities
of the corpus, as the values do not suffice; and persons are distinct within
their title's gender only, with given names replaced letter by letter.

Entities meet for these checks as distinct values (aggregated map-side first).
Replacement needs no join in general, as attempt 0 is computed in place; only
entities with a later attempt are brought back to their documents.

Defined results: null text stays null, a text without entity stays as it is.
Overlaps: the leftmost longest alternative in the order of :data:`KINDS` wins.
Rows equal in id and text get the same result.  Extra columns pass through; an
input column named like a result column is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import add_columns, bind, fresh, has_rows, join_by_key, quoted, stage, text_key

# Titles by gender, given names by gender and script.
MALE = ["Mr", "Herr", "Monsieur", "Señor", "Sr", "г-н", "господин", "κύριος"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа", "госпожа", "κυρία"]
NEUTRAL = ["Dr", "Prof"]
NAMES = {
    ("latin", "m"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leo",
                     "Max", "Noel", "Oscar", "Paul"],
    ("latin", "f"): ["Alma", "Berta", "Clara", "Dora", "Emma", "Flora", "Greta", "Helena", "Ida", "Julia", "Klara", "Lena",
                     "Marta", "Nora", "Olga", "Paula"],
    ("cyrillic", "m"): ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл"],
    ("cyrillic", "f"): ["Анна", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Мария", "Ольга"],
    ("greek", "m"): ["Ανδρέας", "Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Πέτρος"],
    ("greek", "f"): ["Άννα", "Ελένη", "Ειρήνη", "Μαρία", "Σοφία", "Χριστίνα"],
}
LOWER = {"latin": "abcdefghijklmnopqrstuvwxyz", "accented": "àáâãäåæçèéêëìíîïñòóôõöøùúûüýþÿœß",
         "cyrillic": "абвгдежзиклмнопрстуфхцчшщыэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
UPPER = {"latin": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "accented": "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝÞŒ",
         "cyrillic": "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЩЫЭЮЯ", "greek": "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"}

OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
TITLE = "(?:" + "|".join([*MALE, *FEMALE, *NEUTRAL]) + r")\.?"
NAME = r"\p{Lu}[\p{L}'’-]+"
# kind -> pattern, in order of precedence
KINDS = {
    "email": r"(?<![\p{L}\d._%+-])[\p{L}\d][\p{L}\d._%+-]*@[\p{L}\d](?:[\p{L}\d-]*[\p{L}\d])?(?:\.[\p{L}\d](?:[\p{L}\d-]*[\p{L}\d])?)+",
    "secret": r"(?i:\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\s*[=:]\s*[\"'])[A-Za-z0-9+/_=-]{8,}(?=[\"'])",
    "ip": rf"(?<![\d.]){OCTET}(?:\.{OCTET}){{3}}(?![\d]|\.\d)",
    "phone": r"(?<![\d\p{L}])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)"
             r"|(?<![\d\p{L}])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d\p{L}.-])\d{3}[.-]\d{3}[.-]\d{4}(?!\d)",
    "card": r"(?<![\d\p{L}])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\d\p{L}])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "person": rf"(?<!\p{{L}}){TITLE} {NAME}(?: {NAME}){{0,2}}",
}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())
# a text that has none of these holds no entity: most texts end here
HINT = rf"[@\d]|(?<!\p{{L}}){TITLE} \p{{Lu}}|[=:]\s*[\"']"
# country codes of the numbering plan: no code begins another one, unassigned ones have three digits
CODE = r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
RESULT = ["text", "n_entities"]
HEX = ("abcdef", "ABCDEF")   # letters of hexadecimal secrets: looked at before the scripts
CLASSES = ["0123456789", *HEX, *LOWER.values(), *UPPER.values()]
PERMUTED = -1   # attempt number of entities of a crowded format
ROUNDS = 8
PIECE = 32  # hex digits of one digest used per PIECE characters


def kind_of(entity: Column) -> Column:
    """Kind of a found entity; a person's kind holds the gender its title gives."""
    def has(pattern: str) -> Column:
        return F.regexp_like(entity, F.lit(pattern))

    def titled(titles: list[str]) -> str:
        return rf"^(?:{'|'.join(titles)})\.? "
    return (F.when(has(r"^[^\s=:]+@"), "email").when(has(r"[=:]\s*[\"']"), "secret")
            .when(has(titled(MALE)), "person_m").when(has(titled(FEMALE)), "person_f").when(has(titled(NEUTRAL)), "person_n")
            .when(has(rf"^{OCTET}(?:\.{OCTET}){{3}}$"), "ip").when(has(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
            .when(has(r"^(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})$"), "card").otherwise("phone"))


def canonical(kind: Column, entity: Column) -> Column:
    """What two mentions of one entity share: digits of a number, lower case of an address, the secret, the name.

    A phone number with a country code keeps its ``+``.
    """
    digits = F.regexp_replace(entity, r"\D", "")
    return (F.when(kind == "phone", F.concat(F.regexp_extract(entity, r"^\+?", 0), digits))
            .when(kind.isin("card", "ssn"), digits)
            .when(kind == "secret", F.regexp_extract(entity, r"([A-Za-z0-9+/_=-]+)$", 1))
            .when(kind == "email", F.lower(entity))
            .when(kind.startswith("person"), F.regexp_replace(entity, rf"^{TITLE} ", ""))
            .otherwise(entity))


def _stream(key: str, kind: Column, norm: Column, attempt: Column, block: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), kind, norm, attempt.cast("string"), block.cast("string")), 256)


def _draw(hexes: Column, i: Column, n: int) -> Column:
    """Number in [0, n) from the two hex digits for position ``i`` of an array of digests."""
    per = PIECE
    pair = F.substr(F.get(hexes, F.floor(i / per).cast("int")), F.pmod(i, F.lit(per)) * 2 + 1, F.lit(2))
    return F.pmod(F.conv(pair, 16, 10).cast("int"), F.lit(n))


def _pick(hexes: Column, i: Column, letters: str) -> Column:
    return F.substr(F.lit(letters), _draw(hexes, i, len(letters)) + 1, F.lit(1))


def _by_class(hexes: Column, chars: Column, hexadecimal: Column) -> Column:
    """Characters replaced by ones of the same class: digit, or letter of the same script and case."""
    def one(c: Column, i: Column) -> Column:
        out = F.when(c.between("0", "9"), _draw(hexes, i, 10).cast("string"))
        out = out.when(hexadecimal & c.between("a", "f"), _pick(hexes, i, "abcdef"))
        out = out.when(hexadecimal & c.between("A", "F"), _pick(hexes, i, "ABCDEF"))
        for script in LOWER:
            out = out.when(F.instr(F.lit(LOWER[script]), c) > 0, _pick(hexes, i, LOWER[script]))
            out = out.when(F.instr(F.lit(UPPER[script]), c) > 0, _pick(hexes, i, UPPER[script]))
        return out.otherwise(c)
    return F.array_join(F.transform(chars, one), "")


def luhn(digits: Column) -> Column:
    """Luhn sum modulo 10 of a string of digits."""
    n = F.length(digits)

    def worth(d: Column, i: Column) -> Column:
        twice = F.pmod(n - i, F.lit(2)) == 0
        v = d.cast("int") * F.when(twice, F.lit(2)).otherwise(F.lit(1))
        return F.when(v > 9, v - 9).otherwise(v)
    return F.pmod(F.aggregate(F.transform(F.split(digits, ""), worth), F.lit(0), lambda a, x: a + x), F.lit(10))


def surrogate(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    """Canonical surrogate of a canonical entity; attempt ``PERMUTED`` is for crowded formats."""
    return F.when(attempt == PERMUTED, permuted(key, kind, norm)).otherwise(drawn_surrogate(key, kind, norm, attempt))


def is_hexadecimal(kind: Column, norm: Column) -> Column:
    return (kind == "secret") & (F.regexp_like(norm, F.lit(r"^[0-9a-f]+$")) | F.regexp_like(norm, F.lit(r"^[0-9A-F]+$")))


def drawn_surrogate(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    hexes = F.transform(F.sequence(F.lit(0), F.floor(F.length(norm) / PIECE).cast("int")),
                        lambda b: _stream(key, kind, norm, attempt, b))

    def made(h: Column) -> Column:
        chars = F.split(norm, "")
        return bind(_by_class(h, chars, is_hexadecimal(kind, norm)), lambda classed: chosen(h, classed))

    def chosen(h: Column, classed: Column) -> Column:
        # an address keeps its top domain
        mail = F.concat(F.regexp_extract(classed, r"^(.*\.)[^.]*$", 1), F.regexp_extract(norm, r"([^.]*)$", 1))
        octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)),
                                          lambda i: (_draw(h, i, 223) + 1).cast("string")), ".")
        # the last digit of a card number restores its Luhn remainder
        head = F.substr(classed, F.lit(1), F.length(classed) - 1)
        card = F.concat(head, F.pmod(luhn(norm) - bind(F.concat(head, F.lit("0")), luhn), F.lit(10)).cast("string"))
        # a phone number keeps its country code
        code = F.regexp_extract(norm, CODE, 0)
        phone = F.concat(code, F.substr(classed, F.length(code) + 1, F.length(classed)))
        return (F.when(kind == "email", mail).when(kind == "ip", octets).when(kind == "card", card)
                .when(kind == "phone", phone)
                .when(kind.startswith("person"), _person(h, kind, norm, classed)).otherwise(classed))
    return bind(hexes, made)


def _script(norm: Column) -> Column:
    return F.when(F.regexp_like(norm, F.lit(r"^\p{IsCyrillic}")), "cyrillic").when(
        F.regexp_like(norm, F.lit(r"^\p{IsGreek}")), "greek").otherwise("latin")


def _person(h: Column, kind: Column, norm: Column, classed: Column) -> Column:
    script = _script(norm)
    gender = F.when(kind != "person_n", F.right(kind, F.lit(1))).when(_draw(h, F.lit(31), 2) == 0, "m").otherwise("f")
    first = F.lit(None).cast("string")
    for (s, g), names in NAMES.items():
        first = F.when((script == s) & (gender == g), F.get(F.array(*map(F.lit, names)), _draw(h, F.lit(30), len(names)))) \
            .otherwise(first)
    # one name only: it is taken as a family name and replaced letter by letter
    return F.when(F.instr(norm, " ") == 0, classed).otherwise(F.concat(first, F.regexp_extract(classed, r"^\S+(.*)$", 1)))


def rendered(kind: Column, entity: Column, canon: Column) -> Column:
    """A canonical surrogate in the format of one mention."""
    def digits_into(d: Column) -> Column:
        # running number of the digit at each position
        chars = F.split(entity, "")
        at = F.transform(chars, lambda c, i: F.length(F.regexp_replace(F.substr(entity, F.lit(1), i), r"\D", "")))
        return F.array_join(F.zip_with(chars, at, lambda c, k: F.when(
            c.between("0", "9"), F.substr(d, k + 1, F.lit(1))).otherwise(c)), "")

    def formatted(c: Column) -> Column:
        shouted = (F.upper(entity) == entity) & (F.lower(entity) != entity)
        return (F.when(kind.isin("phone", "card", "ssn"), bind(F.ltrim(c, F.lit("+")), digits_into))
                .when(kind == "email", F.when(shouted, F.upper(c)).otherwise(c))
                .when(kind == "secret", F.concat(F.regexp_extract(entity, r"^(.*?)[A-Za-z0-9+/_=-]+$", 1), c))
                .when(kind.startswith("person"), F.concat(F.regexp_extract(entity, rf"^({TITLE} )", 1), c)).otherwise(c))
    return bind(canon, formatted)


def _described(entities: Column) -> Column:
    """Entities with kind and canonical form."""
    return F.transform(F.transform(entities, lambda e: F.struct(e.alias("e"), kind_of(e).alias("kind"))), lambda s: F.struct(
        s["e"].alias("e"), s["kind"].alias("kind"), canonical(s["kind"], s["e"]).alias("norm")))


def _found(docs: DataFrame, text: Column) -> Column:
    return F.when(text.isNotNull() & F.regexp_like(text, F.lit(HINT)), F.regexp_extract_all(text, F.lit(ANY), 0)).otherwise(
        F.array().cast("array<string>"))


def family(kind: Column) -> Column:
    """What collision checks take as one kind: persons of all titles."""
    return F.when(kind.startswith("person"), "person").otherwise(kind)


def _cells(kind: Column, norm: Column) -> Column:
    """Characters (c) with the letters they may become (k: number in ``CLASSES``, -1: they stay), how many (r), and their own place (x)."""
    start = F.when(kind == "phone", F.length(F.regexp_extract(norm, CODE, 0))).otherwise(0)
    end = F.when(kind == "email", F.length(F.regexp_extract(norm, r"^(.*\.)[^.]*$", 1))).otherwise(F.length(norm))

    def one(c: Column, i: Column, hexadecimal: Column) -> Column:
        k = F.lit(-1)
        for n, letters in reversed(list(enumerate(CLASSES))):
            own = F.instr(F.lit(letters), c) > 0
            if letters in HEX:
                own = own & hexadecimal
            k = F.when(own, F.lit(n)).otherwise(k)
        return F.when((i >= start) & (i < end), k).otherwise(F.lit(-1))

    classed = bind(is_hexadecimal(kind, norm), lambda h: F.transform(
        F.split(norm, ""), lambda c, i: F.struct(c.alias("c"), one(c, i, h).alias("k"))))
    letters = F.lit(CLASSES)
    return F.transform(classed, lambda s: F.when(s["k"] < 0, F.struct(s["c"].alias("c"), s["k"].alias("k"), F.lit(1).cast("long").alias("r"),
                                                                    F.lit(0).cast("long").alias("x"))).otherwise(
        F.struct(s["c"].alias("c"), s["k"].alias("k"), F.length(F.get(letters, s["k"])).cast("long").alias("r"),
                 (F.instr(F.get(letters, s["k"]), s["c"]) - 1).cast("long").alias("x"))))


def _values(cells: Column) -> Column:
    return F.aggregate(cells, F.lit(1).cast("long"), lambda a, s: a * s["r"])


def permuted(key: str, kind: Column, norm: Column) -> Column:
    """Another value of the entity's format, by a keyed permutation without fixed points.

    The free characters are two numbers, of the left and the right half, to mixed
    bases.  A Feistel network that adds to one half modulo its number of values permutes
    their pairs; going through it, one step on around all pairs, and back again
    gives a permutation that moves every value.
    """
    def keyed(cells: Column, *parts: Column) -> Column:
        shape = F.array_join(F.transform(cells, lambda s: F.when(s["k"] < 0, s["c"]).otherwise(s["k"].cast("string"))), "\x1e")
        digest = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("format"), kind, shape, *[p.cast("string") for p in parts]), 256)
        return F.conv(F.substr(digest, F.lit(1), F.lit(12)), 16, 10).cast("long")

    def run(cells: Column) -> Column:
        half = F.ceil(F.size(cells) / 2).cast("int")
        left, right = F.slice(cells, F.lit(1), half), F.slice(cells, half + 1, F.size(cells) - half)
        number = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda a, s: a * s["r"] + s["x"])
        return bind(F.struct(_values(left).alias("a"), _values(right).alias("b"), number(left).alias("l"), number(right).alias("r")),
                    lambda v: moved(cells, left, right, v))

    def network(cells: Column, v: Column, pair: Column, rounds: list[int], sign: int) -> Column:
        def step(p: Column, j: Column) -> Column:
            on_left = F.struct(F.pmod(p["l"] + sign * F.pmod(keyed(cells, j, p["r"]), v["a"]), v["a"]).alias("l"), p["r"].alias("r"))
            on_right = F.struct(p["l"].alias("l"), F.pmod(p["r"] + sign * F.pmod(keyed(cells, j, p["l"]), v["b"]), v["b"]).alias("r"))
            return F.when(j % 2 == 0, on_left).otherwise(on_right)
        return F.aggregate(F.lit(rounds), pair, step)

    def moved(cells: Column, left: Column, right: Column, v: Column) -> Column:
        rounds = list(range(ROUNDS))
        there = network(cells, v, F.struct(v["l"].alias("l"), v["r"].alias("r")), rounds, 1)
        total = v["a"] * v["b"]
        on = bind(there, lambda p: F.pmod(p["l"] * v["b"] + p["r"] + 1 + F.pmod(keyed(cells, F.lit("step")), total - 1), total))
        start = bind(on, lambda n: F.struct(F.floor(n / v["b"]).cast("long").alias("l"), F.pmod(n, v["b"]).alias("r")))
        return F.when(total > 1, bind(network(cells, v, start, rounds[::-1], -1), lambda p: F.concat(
            spelled(left, p["l"]), spelled(right, p["r"])))).otherwise(norm)

    def spelled(part: Column, n: Column) -> Column:
        def one(s: Column, i: Column) -> Column:
            below = _values(F.slice(part, i + 2, F.size(part)))
            return F.when(s["k"] < 0, s["c"]).otherwise(F.substr(
                F.get(F.lit(CLASSES), s["k"]), F.pmod(F.floor(n / below).cast("long"), s["r"]).cast("int") + 1, F.lit(1)))
        return F.array_join(F.transform(part, one), "")

    return bind(_cells(kind, norm), run)


def room(kind: Column, norm: Column) -> tuple[Column, Column]:
    """Format that an entity shares with its surrogates, and log2 of the number of its values.

    A person of several names shares the script, and the letters after the given
    name.  Card numbers (10**12 and more values of a length) and addresses of hosts
    stand for themselves, with a null number: their values are not counted.
    """
    person, several = kind.startswith("person"), F.instr(norm, " ") > 0
    script = _script(norm)
    names = F.lit(None).cast("double")
    for s in ("latin", "cyrillic", "greek"):
        names = F.when(script == s, math.log2(len(NAMES[s, "m"]))).otherwise(names)

    def described(cells: Column) -> Column:
        after = F.when(person & several, F.length(F.regexp_extract(norm, r"^(\S+)", 1))).otherwise(0)
        rest = F.slice(cells, after + 1, F.size(cells))
        shape = F.array_join(F.transform(rest, lambda s: F.when(s["k"] < 0, s["c"]).otherwise(s["k"].cast("string"))), "\x1e")
        bits = F.aggregate(rest, F.lit(0.0), lambda a, s: a + F.log2(s["r"]))
        return F.struct(F.when(person & several, F.concat_ws("\x1f", script, kind, shape)).otherwise(shape).alias("shape"),
                        F.when(person & several, bits + names).otherwise(bits).alias("bits"))
    known = bind(_cells(kind, norm), described)
    counted = ~kind.isin("card", "ip")
    return F.when(counted, known["shape"]).otherwise(norm), F.when(counted, known["bits"])


def crowded(known: DataFrame) -> DataFrame:
    """(fam, shape, n): formats of which the ``n`` entities and as many surrogates fill more than three quarters."""
    shape, bits = room(F.col("kind"), F.col("norm"))
    names = known.withColumns({"shape": shape, "bits": F.round(bits, 6)}).where("bits > 0 AND bits < 62") \
        .groupBy("fam", "shape", "bits", "norm").agg(F.count("*").alias("n"))
    return names.groupBy("fam", "shape", "bits").agg(F.sum("n").alias("n"), F.count("*").alias("real")) \
        .where(F.col("n") + F.col("real") > F.pow(F.lit(2.0), F.col("bits")) * 0.75 + 0.01).select("fam", "shape", "n")


def attempts(entities: DataFrame, key: str) -> DataFrame:
    """(kind, norm, attempt, n) of the entities whose first surrogate is not the settled one; ``entities``: kind, norm."""
    known = stage(entities.groupBy("kind", "norm").agg(F.count("*").alias("n")).withColumn("fam", family(F.col("kind"))),
                  "entities")
    full = stage(crowded(known), "crowded")
    shaped = known.withColumnsRenamed({"n": "mentions"}).withColumn("shape", room(F.col("kind"), F.col("norm"))[0])
    met = join_by_key(shaped, full, ["fam", "shape"], ["kind", "norm"], "n", full.agg(F.sum("n")).first()[0] or 0)
    known = stage(met.select("kind", "norm", "fam", F.col("mentions").alias("n"), F.col("n").isNotNull().alias("full")), "entities")
    later = known.where("full").select("kind", "norm", F.lit(PERMUTED).alias("attempt"), "n")
    current = known.where("NOT full").select("kind", "norm", "fam", "n", F.lit(0).alias("attempt"))
    occupied = current.select("fam", F.col("norm").alias("s")).distinct()
    me = F.struct("norm", "kind")
    while True:
        drawn = stage(current.withColumn("s", drawn_surrogate(key, F.col("kind"), F.col("norm"), F.col("attempt"))), "surrogates")
        hit = drawn.join(occupied, ["fam", "s"]).select("kind", "norm")
        # the smallest entity keeps a shared surrogate: partial aggregation, no group is gathered
        shared = drawn.groupBy("fam", "s").agg(F.min(me).alias("keeper"), F.count("*").alias("many")).where("many > 1")
        twice = drawn.join(shared, ["fam", "s"]).where(me != F.col("keeper")).select("kind", "norm")
        again = hit.unionAll(twice).distinct().withColumn("_again", F.lit(True))
        marked = stage(drawn.join(again, ["kind", "norm"], "left"), "settled")
        settled = marked.where("_again IS NULL")
        later = later.unionByName(settled.where("attempt > 0").select("kind", "norm", "attempt", "n"))
        if not has_rows(marked.where("_again")):
            return later
        # only the losers draw again, against what is settled and what is real
        occupied = occupied.unionByName(settled.select("fam", "s"))
        current = marked.where("_again").select("kind", "norm", "fam", "n", (F.col("attempt") + 1).alias("attempt"))


def surrogates(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with entities in ``text`` replaced and ``n_entities``."""
    text = quoted(text_col)
    d, t, redo_col, found_col = fresh(docs, "_d", "_t", "_redo", "_found")
    mentions = docs.select(quoted(id_col).alias("d"), text_key(text).alias("t"), F.explode(_described(_found(docs, text))).alias("m"))
    mentions = stage(mentions.select("d", "t", "m.kind", "m.norm"), "mentions")
    later = stage(attempts(mentions, key), "attempts")
    total = later.agg(F.sum("n")).first()[0] or 0
    met = join_by_key(mentions, later, ["kind", "norm"], ["d", "t"], "n", total).where("attempt is not null")
    redo = met.groupBy("d", "t").agg(F.map_from_entries(F.collect_set(F.struct(
        F.concat_ws("\x1f", "kind", "norm").alias("k"), F.col("attempt").alias("v")))).alias(redo_col))
    redo = redo.withColumnsRenamed({"d": d, "t": t})
    joined = docs.join(redo, quoted(id_col).eqNullSafe(F.col(d)) & (text_key(text) == F.col(t)), "left")

    def replaced(s: Column) -> Column:
        attempt = F.coalesce(F.try_element_at(F.col(redo_col), F.concat_ws("\x1f", s["kind"], s["norm"])), F.lit(0))
        return rendered(s["kind"], s["e"], surrogate(key, s["kind"], s["norm"], attempt))
    found = joined.withColumn(found_col, _described(_found(joined, text)))
    new = F.transform(found_col, replaced)
    between = F.split(text, ANY)
    clean = F.when(F.size(found_col) == 0, text).otherwise(F.concat(F.get(between, F.lit(0)), F.array_join(F.zip_with(
        new, F.slice(between, F.lit(2), F.size(found_col)), lambda a, b: F.concat(a, b)), "")))
    return add_columns(found, {text_col: clean, "n_entities": F.size(found_col).cast("long")}).drop(d, t, redo_col, found_col)

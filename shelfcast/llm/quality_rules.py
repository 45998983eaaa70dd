"""Line-first quality rules (operator 7), DataFrame functions only.

Every line is judged alone, failing lines are removed, and a document whose
remaining text is too small a part of what it had is rejected.

Line rules (each a parameter of :class:`LineRules`):

* punctuation: a line longer than a heading (``heading_words``) must hold a
  sentence mark; a line with more bursts of marks (two or more in a row, or a
  symbol run) than ``max_burst_ratio`` of its words fails; a line with more symbols
  (``[#*$%&|<>]``) than ``max_symbol_ratio`` of its words fails;
* navigation: a line cut into many short cells by ``|``, ``>`` or bullets, or a
  short line of menu words, fails;
* boilerplate: a line of at most ``boilerplate_words`` words with a known
  pattern (cookie notice, "all rights reserved", licence line) fails; so does a
  line with a phrase of up to three words four times in a row, a line without
  lower-case letters that is longer than a heading, and a repeat of a line seen
  earlier in the document.

Blank lines are neutral.  Document rules: at least ``min_words`` words, at most
``max_repeat_words`` of the words inside 8-word windows that the text repeats,
and at least ``min_kept_chars`` of the word characters left after cleaning.

Defined results: a null text has no words, so it fails the base rule and is
rejected; so does an empty text.  Repeated rows are judged one by one and alike.
An input column named like a result column is replaced; other extra columns
pass through.  An empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import bind, quoted, without, words_of

SYMBOLS = r"[#*$%&|<>]"
WORD = r"[^\x20\x09-\x0D]+"
RESULT = ["clean_text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines_removed",
          "kept_chars", "base_failed", "kept"]
# Fixed patterns of lines that belong to a site, not to a text.
BOILERPLATE = (r"(?i)(all rights reserved|cookie(s)? (policy|notice|settings)|terms of (use|service)|privacy policy"
               r"|subscribe to our newsletter|javascript (is )?(disabled|required)|click here to"
               r"|^\W*(licensed|released) under |work is licensed under|^\W*copyright )")
# sentence and clause marks: Latin, CJK, Devanagari, Armenian, Arabic, Ethiopic, Khmer, Tibetan, Myanmar, Mongolian, Hebrew
MARK = r"[.!?;:,…。！？；：，、।॥։؟۔؛،።፣፤፥፧፨។៕།༎၊။᠂᠃׃]"
CELL = r"[|>•»·]"
# what the counted rules look for: one scan finds the few lines that need counting
NOISE = r"[!?]{2}|[|>•»·#*$%&<]"
# a phrase of up to three words, four times in a row from any word on (\s is ASCII white space)
PHRASE = (r"(?<!\S)(?:(\S++)(?:\s++\1){3}|(\S++)\s++(\S++)(?:\s++\2\s++\3){3}"
          r"|(\S++)\s++(\S++)\s++(\S++)(?:\s++\4\s++\5\s++\6){3})(?!\S)")
MENU = (r"(?i)^\W*((home|login|log in|sign in|sign up|register|about( us)?|contact( us)?|menu|search|next|previous"
        r"|share|tweet|sitemap|faq|help)(\W+|$))+$")


@dataclass(frozen=True)
class LineRules:
    heading_words: int = 12
    max_burst_ratio: float = 0.5
    max_symbol_ratio: float = 0.1
    max_cell_ratio: float = 0.25
    boilerplate_words: int = 25
    min_words: int = 20
    max_repeat_percent: int = 30
    min_kept_ratio: float = 0.5
    window: int = 8


def with_window_digests(df: DataFrame, words: str, out: str, k: int) -> DataFrame:
    """Column ``out``: one 64-bit digest per window of ``k`` words (a power of two), by doubling.

    Each doubling is a projection of its own, so it is evaluated once per word.
    """
    df = df.withColumn(out, F.transform(words, lambda w: F.xxhash64(w)))
    def doubled(step: int) -> Column:
        return F.transform(out, lambda x, i: F.xxhash64(x, F.get(out, i + step)))

    for step in (2 ** n for n in range(k.bit_length() - 1)):
        df = df.withColumn(out, doubled(step))
    return df.withColumn(out, F.slice(out, F.lit(1), F.greatest(F.size(out) - (k - 1), F.lit(0))))


def repeated_window_words(digests: Column, k: int) -> Column:
    """Number of words inside windows whose digest stands at least twice in ``digests``.

    Most texts repeat nothing and end at the distinct count.  Otherwise the
    digests are sorted with their positions, equal neighbours mark repeated
    windows, and the marked positions are merged in one sweep: n log n work for
    a text of n words.
    """
    pairs = F.array_sort(F.transform(digests, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def starts(p: Column) -> Column:
        dup = F.transform(p, lambda x, i: F.when(
            x["h"].eqNullSafe(F.get(p, i - 1)["h"]) | x["h"].eqNullSafe(F.get(p, i + 1)["h"]), x["i"]))
        return F.array_sort(F.filter(dup, lambda x: x.isNotNull()))
    covered = F.aggregate(
        bind(pairs, starts), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct((a["n"] + s + k - F.greatest(s, a["end"])).alias("n"), (s + k).alias("end")),
        lambda a: a["n"])
    return F.when(F.size(F.array_distinct(digests)) == F.size(digests), F.lit(0)).otherwise(covered)


def line_verdict(line: Column, rules: LineRules, symbols_at_all: Column) -> Column:
    """True if a line passes the rules that need no other line (blank lines pass).

    ``symbols_at_all`` (of the document) saves the symbol counts where there is none.
    """
    def count(pattern: str) -> Column:
        return F.regexp_count(line, F.lit(pattern))

    def has(pattern: str) -> Column:
        return F.regexp_like(line, F.lit(pattern))

    def judged(n: Column) -> Column:
        symbols = F.when(symbols_at_all, (count(r"[#*$%&]{2,}") > n * rules.max_burst_ratio)
                         | (count(SYMBOLS) > n * rules.max_symbol_ratio)).otherwise(F.lit(False))
        cells = bind(count(CELL), lambda c: (c > 1) & (c > n * rules.max_cell_ratio))
        bursts = count(r"[!?]{2,}") > n * rules.max_burst_ratio
        return ~(((n > rules.heading_words) & (~has(MARK) | ~has(r"\p{Ll}") & has(r"\p{Lu}"))) | has(PHRASE)
                 | F.when(has(NOISE), symbols | cells | bursts).otherwise(F.lit(False))
                 | ((n <= rules.boilerplate_words) & (has(MENU) | has(BOILERPLATE))))
    return ~has(WORD) | bind(count(WORD), judged)


def first_of_equal_lines(lines: Column) -> Column:
    """Per line: false if an equal line with a word stands earlier (one sort, no search per line)."""
    by_line = F.array_sort(F.transform(lines, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    marked = bind(by_line, lambda p: F.array_sort(F.transform(p, lambda x, k: F.struct(
        x["i"].alias("i"), (x["x"].eqNullSafe(F.get(p, k - 1)["x"]) & F.regexp_like(x["x"], F.lit(WORD))).alias("again")))))
    return F.transform(marked, lambda x: ~x["again"])


def _word_chars(text: Column) -> Column:
    """Code points outside ASCII white space."""
    for ch in (" ", "\t", "\n", "\x0b", "\x0c", "\r"):
        text = F.replace(text, F.lit(ch), F.lit(""))
    return F.length(text).cast("long")


def quality_rules(docs: DataFrame, text_col: str = "text", rules: LineRules | None = None) -> DataFrame:
    """Judge every document and its lines; see the module docstring.

    Adds ``clean_text`` (the text without failing lines), ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``n_lines_removed``, ``kept_chars`` (word characters in ``clean_text``),
    ``base_failed`` and ``kept``.
    """
    rules = rules or LineRules()
    if rules.window < 1 or rules.window & (rules.window - 1):
        raise ValueError("the window is a power of two: its digests are made by doubling")
    df = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("row"),
                     F.coalesce(quoted(text_col), F.lit("")).alias("txt"))
    df = df.withColumns({"words": words_of(F.col("txt")), "lines": F.split("txt", "\n")})
    df = with_window_digests(df, "words", "digests", rules.window)
    worded = F.filter("lines", lambda x: F.regexp_like(x, F.lit(WORD)))
    df = df.select(
        "row", "txt", "lines",
        F.size("words").cast("long").alias("n_words"),
        _word_chars(F.col("txt")).alias("word_chars"),
        F.regexp_count("txt", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        bind(worded, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_window_words(F.col("digests"), rules.window).cast("long").alias("n_repeat_words"))
    passes = F.transform("lines", lambda x: line_verdict(x, rules, F.col("n_symbols") > 0))
    passes = F.when(F.col("n_dup_lines") == 0, passes).otherwise(
        F.zip_with(passes, first_of_equal_lines(F.col("lines")), lambda a, b: a & b))
    df = df.withColumn("passes", passes)
    df = df.withColumn("n_lines_removed", F.size(F.filter("passes", lambda x: ~x)).cast("long"))
    whole = F.col("n_lines_removed") == 0
    df = df.withColumn("clean_text", F.when(whole, F.col("txt")).otherwise(
        F.array_join(F.filter("lines", lambda x, i: F.get("passes", i)), "\n")))
    df = df.withColumn("kept_chars", F.when(whole, F.col("word_chars")).otherwise(_word_chars(F.col("clean_text"))))
    base_failed = (F.col("n_words") < rules.min_words) | \
        (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    df = df.withColumn("base_failed", base_failed)
    df = df.withColumn("kept", ~F.col("base_failed") & (F.col("kept_chars") >= rules.min_kept_ratio * F.col("word_chars")))
    # The generator is a border for the optimiser: a filter on a result column is not pushed below it, where
    # every step above would be written out again inside the condition.
    rest = without(docs, RESULT)
    df = df.select("row", F.explode(F.array(F.struct(*RESULT))).alias("result"))
    return df.select(*[F.col("row").getField(c).alias(c) for c in rest], *[F.col(f"result.{c}") for c in RESULT])

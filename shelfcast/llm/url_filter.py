"""URL filter: domain rules, then a character language-model ratio (operator 3).

Rules decide first.  A rule has an action, a host and a path; it fits its host
and all subdomains if the url's path starts with the rule's; of several the
longest (host and path together) wins, ties go to the smaller text.

The urls that rules decide train two variable-order Markov models over url
characters, one of accepted and one of rejected urls: Witten-Bell smoothing
blends the longest context of up to ``ORDER`` characters with all shorter ones.
All other urls are judged by the difference of both log-likelihoods per
character against a calibrated threshold: a quarter of the decided urls, by hash
of the url, trains no model; over a histogram of ``BINS`` fixed bins of their
scores the threshold has the smallest sum of both error rates (the middle of
several).  Where the held-out quarter lacks one of the two kinds, all decided
urls calibrate.

Characters are mapped to an alphabet of ``len(ALPHABET) + 2`` symbols (A-Z
lower-cased, digits as one, one symbol for all others, one for the border), so
the count table has at most ``BASE ** (ORDER + 1)`` rows and the ratio table
sent to all tasks has a fixed size (10 MB) whatever the number of urls.

Defined results: null, or no ``://``: host and path are empty, no rule fits,
the method judges the whole string; a null or empty url is blocked.  If the rules
decide no url of one of the two kinds there is no ratio and the rest is allowed.
Null hosts' rows, repeated rows and extra columns pass through; an input column
named like a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import add_columns, fresh, quoted, ship, without

RESULT = ["host", "path", "rule", "verdict", "llr"]
ALPHABET = "abcdefghijklmnopqrstuvwxyz0/.-_?=&#%:"
BORDER, OTHER = 0, len(ALPHABET) + 1
BASE, ORDER = len(ALPHABET) + 2, 3
BINS, SPAN = 4096, 8.0
HELD_OUT = 4  # one in so many decided urls calibrates and does not train
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
AUTHORITY = r"(?s)^.*?://([^/?#]*)([^?#]*)"

# code of every byte: letters in lower case, all digits as "0", anything else OTHER
CODES = np.array([OTHER if (at := ALPHABET.find("0" if chr(b).isdigit() and b < 128 else chr(b).lower() if b < 128 else "\0")) < 0
                  else at + 1 for b in range(256)], np.int32)


class Rule(NamedTuple):
    action: str  # "allow" or "block"
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    whole = F.coalesce(url, F.lit(""))
    return (F.translate(F.regexp_extract(whole, AUTHORITY, 1), UPPER, LOWER), F.regexp_extract(whole, AUTHORITY, 2))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(text, action) of the rule that decides, null if none fits."""
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text), reverse=True):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, action = F.when(fits, F.lit(r.text)).otherwise(text), F.when(fits, F.lit(r.action)).otherwise(action)
    return text, action


def gram_codes(url: str) -> np.ndarray:
    """Codes of all (context, character) windows of a url, framed by borders: base-``BASE`` numbers."""
    c = np.concatenate((np.zeros(ORDER, np.int32), CODES[np.frombuffer(url.encode(), np.uint8)], np.zeros(1, np.int32)))
    out = np.zeros(len(c) - ORDER, np.int32)
    for k in range(ORDER + 1):
        out = out * BASE + c[k:len(c) - ORDER + k]
    return out


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """Witten-Bell blended log-probabilities for all contexts of ``ORDER`` characters; ``counts`` by gram code."""
    full = counts.reshape((BASE,) * (ORDER + 1)).astype(np.float64)
    p = np.full(BASE, 1.0 / BASE)
    for k in range(ORDER + 1):
        # counts of the last k characters and the next one
        c = full.sum(axis=tuple(range(ORDER - k))) if k < ORDER else full
        total, kinds = c.sum(axis=-1, keepdims=True), (c > 0).sum(axis=-1, keepdims=True)
        p = np.where(total > 0, (c + kinds * p) / np.maximum(total + kinds, 1), np.broadcast_to(p, c.shape))
    return np.log(p).reshape(-1)


def filter_urls(pages: DataFrame, rules: Sequence[Rule], url_col: str = "url") -> DataFrame:
    """``pages`` plus ``host``, ``path``, ``rule``, ``verdict`` and ``llr`` (log-likelihood difference per character)."""
    spark = pages.sparkSession
    ship(spark)
    base = pages.select(*[quoted(c) for c in without(pages, RESULT)])
    url, action = fresh(base, "_url", "_action")
    host, path = host_and_path(quoted(url_col))
    parsed = base.withColumn(url, quoted(url_col)).withColumns({"host": host, "path": path})
    rule, act = rule_of(F.col("host"), F.col("path"), rules)
    parsed = parsed.withColumns({"rule": rule, action: act})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, name in enumerate(("allow", "block")):
                grams = [gram_codes(u) for u, a in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                         if a == name and u]
                if grams:
                    code, n = np.unique(np.concatenate(grams), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(code), kind, np.int32)), pa.array(code), pa.array(n.astype(np.int64))],
                        ["kind", "code", "n"])
    held = F.pmod(F.xxhash64(F.coalesce(F.col(url), F.lit(""))), F.lit(HELD_OUT)) == 0
    decided = parsed.where(F.col(action).isNotNull() & ~held).select(url, action)
    counts = decided.mapInArrow(count, "kind int, code int, n long").groupBy("kind", "code").agg(F.sum("n").alias("n"))
    table = np.zeros((2, BASE ** (ORDER + 1)), np.int64)
    for r in counts.toLocalIterator():  # at most 2 * BASE ** (ORDER + 1) rows
        table[r["kind"], r["code"]] = r["n"]
    trained = bool(table[0].any() and table[1].any())
    ratio = (log_probabilities(table[0]) - log_probabilities(table[1])).astype(np.float32) if trained \
        else np.zeros(BASE ** (ORDER + 1), np.float32)
    sent = spark.sparkContext.broadcast(ratio)

    def llr(u: str | None) -> float:
        return float(sent.value[gram_codes(u)].mean()) if u else 0.0

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls = batch.column(batch.schema.names.index(url)).to_pylist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([llr(u) for u in urls], pa.float64())],
                                             [*batch.schema.names, "llr"])
    scored = parsed.mapInArrow(score, T.StructType(parsed.schema.fields + [T.StructField("llr", T.DoubleType())]))
    threshold = _threshold(scored, action, held) if trained else -np.inf
    verdict = F.coalesce(F.col(action), F.when((F.coalesce(F.col(url), F.lit("")) != "") & (
        F.col("llr") >= F.lit(float(threshold))), "allow").otherwise("block"))
    return add_columns(scored, {"verdict": verdict}).drop(url, action)


def _threshold(scored: DataFrame, action: str, held: Column) -> float:
    """The score with the smallest sum of both error rates on the held-out urls that rules decide."""
    at = F.least(F.greatest(F.floor((F.col("llr") + SPAN) / (2 * SPAN) * BINS), F.lit(0)), F.lit(BINS - 1))
    both = np.zeros((2, 2, BINS))
    for r in scored.where(F.col(action).isNotNull()).groupBy(held.alias("h"), F.col(action).alias("a"), at.alias("b")).count().collect():
        both[int(r["h"]), int(r["a"] == "block"), r["b"]] += r["count"]
    hist = both[1] if both[1].any(axis=1).all() else both.sum(axis=0)
    below = np.concatenate((np.zeros((2, 1)), hist.cumsum(axis=1)), axis=1) / np.maximum(hist.sum(axis=1, keepdims=True), 1)
    errors = below[0] + (1 - below[1])  # accepted below the cut, rejected at or above it
    best = np.flatnonzero(errors == errors.min())
    return (best[0] + best[-1]) / 2 / BINS * 2 * SPAN - SPAN

"""Exact quantiles (numpy ``linear`` interpolation) without an unbounded map, all ranks at once.

Spark's exact ``percentile`` aggregates a value -> count map that is merged in
one task: fine when the column has few distinct values (counts, units), not
for continuous columns at scale.  Here every order statistic that any column and
probability needs is a *target* with an open interval it must lie in.  One scan
serves all open targets with one aggregate:

* the first scan counts each column and builds a mergeable sketch (KLL) of it;
* from a sketch of its interval a target gets two pivots just below and above its
  rank.  The next scan counts what lies below and at either pivot, exactly, and builds
  the sketch of the values between them.  The rank then is at a pivot (an answer,
  however many ties there are), or between them (the interval shrinks by the sketch's
  accuracy, about 1,600-fold), or, if the sketch was off, beyond one (the interval still shrinks);
* an interval of at most ``max_in_bracket`` values (a few thousand, before a round of pivots has been
  tried) is collected by the next scan and ranked.

So an interval holds n, n / 1600, n / 2.6e6 values after one, two and three scans: the usual end
is the fourth scan for up to 2.6e11 rows, the fifth for any size.  What reaches the driver are
counts, pivots and at most ``max_in_bracket`` values per target; sketches stay in a one-row table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.session import cut_lineage

SKETCH = 32768  # KLL's k: rank error about 1 in 10,000, and about a MB a sketch
FEW = 4096      # values that are collected rather than counted at pivots while a round of pivots still shrinks much


@dataclass(eq=False)
class _Target:
    column: int
    rank: int                      # 0-based in the whole column
    low: float | None = None       # the open interval; None: no bound
    high: float | None = None
    below: int = 0                 # values at or below ``low``
    inside: int = 0
    pivots: tuple[float, float] | None = None
    answer: float | None = None

    def within(self, v: Column, low: float | None, high: float | None) -> Column:
        c = v.isNotNull()
        c = c if low is None else c & (v > F.lit(low))
        return c if high is None else c & (v < F.lit(high))

    def fractions(self, accuracy: int) -> list[float]:
        centre = (self.rank - self.below + 0.5) / self.inside
        margin = 3 / accuracy
        return [max(0.0, centre - margin), min(1.0, centre + margin)]


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], max_in_bracket: int = 100_000,
                    accuracy: int = 10_000) -> list[float | None]:
    """Exact quantiles of one column (None for each if it has no value)."""
    return exact_quantiles_of(df, [col], probs, max_in_bracket, accuracy)[col]


def exact_quantiles_of(df: DataFrame, cols: Sequence[str], probs: Sequence[float], max_in_bracket: int = 100_000,
                       accuracy: int = 10_000) -> dict[str, list[float | None]]:
    """Exact quantiles of several columns; nulls and NaN are left out.  ``accuracy`` sets how near pivots go (3 in
    ``accuracy`` of the interval to either side)."""
    return quantiles_and_scans(df, cols, probs, max_in_bracket, accuracy)[0]


def quantiles_and_scans(df: DataFrame, cols: Sequence[str], probs: Sequence[float], max_in_bracket: int = 100_000,
                        accuracy: int = 10_000) -> tuple[dict[str, list[float | None]], int]:
    """The quantiles and how many times ``df`` was scanned for them."""
    vals = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"v{i}") for i, c in enumerate(cols)])
    scans = 1
    first = cut_lineage(vals.agg(*[x for i in range(len(cols)) for x in (
        F.count(f"v{i}").alias(f"n{i}"), F.kll_sketch_agg_double(f"v{i}", F.lit(SKETCH)).alias(f"k{i}"))]))
    n = first.select(*[f"n{i}" for i in range(len(cols))]).first()
    need: dict[tuple[int, int], tuple[int, int, float]] = {}
    targets: dict[tuple[int, int], _Target] = {}
    for i in range(len(cols)):
        for j, p in enumerate(probs):
            if not n[i]:
                continue
            h = (n[i] - 1) * float(p)
            need[i, j] = (math.floor(h), math.ceil(h), h - math.floor(h))
            for k in need[i, j][:2]:
                targets.setdefault((i, k), _Target(i, k, inside=n[i]))
    few = min(FEW, max_in_bracket)
    _pivot(first, {t: f"k{t.column}" for t in targets.values() if t.inside > few}, accuracy)
    while todo := [t for t in targets.values() if t.answer is None]:
        scans += 1
        _narrow(vals, todo, few if scans < 3 else max_in_bracket, max_in_bracket, accuracy)
    out: dict[str, list[float | None]] = {}
    for i, c in enumerate(cols):
        out[c] = []
        for j in range(len(probs)):
            if (i, j) not in need:
                out[c].append(None)
                continue
            lo, hi, part = need[i, j]
            a, b = targets[i, lo].answer, targets[i, hi].answer
            out[c].append(a if lo == hi else a + (b - a) * part)
    return out, scans


def _pivot(row: DataFrame, sketches: dict, accuracy: int) -> None:
    """Pivots of targets from the sketches (columns of a one-row table) of their intervals."""
    asked = list(sketches.items())
    if not asked:
        return
    got = row.select(*[F.kll_sketch_get_quantile_double(name, F.lit(t.fractions(accuracy))).alias(f"q{m}")
                       for m, (t, name) in enumerate(asked)]).first()
    for m, (t, _) in enumerate(asked):
        t.pivots = (float(got[m][0]), float(got[m][1]))


def _narrow(vals: DataFrame, todo: list[_Target], max_in: int, next_in: int, accuracy: int) -> None:
    """One scan for all open targets: small intervals are collected, others counted at their pivots and sketched between.

    ``next_in`` is the size up to which the next scan will collect.
    """
    aggs = []
    for m, t in enumerate(todo):
        v = F.col(f"v{t.column}")
        if t.inside <= max_in:
            aggs.append(F.sort_array(F.collect_list(F.when(t.within(v, t.low, t.high), v))).alias(f"s{m}"))
            continue
        low, high = t.pivots or (t.low, t.high)
        if t.pivots:
            aggs += [F.count_if(v < low).alias(f"a{m}"), F.count_if(v <= low).alias(f"b{m}"),
                     F.count_if(v < high).alias(f"c{m}"), F.count_if(v <= high).alias(f"d{m}")]
        aggs.append(F.kll_sketch_agg_double(F.when(t.within(v, low, high), v), F.lit(SKETCH)).alias(f"k{m}"))
    row = cut_lineage(vals.agg(*aggs))
    got = row.drop(*[c for c in row.columns if c.startswith("k")]).first()
    sketches = {}
    for m, t in enumerate(todo):
        if t.inside <= max_in:
            t.answer = float(got[f"s{m}"][t.rank - t.below])
        elif t.pivots is None:
            sketches[t] = f"k{m}"
        else:
            if _decide(t, got[f"a{m}"], got[f"b{m}"], got[f"c{m}"], got[f"d{m}"]) and t.inside > next_in:
                sketches[t] = f"k{m}"
    _pivot(row, sketches, accuracy)


def _decide(t: _Target, before_low: int, up_to_low: int, before_high: int, up_to_high: int) -> bool:
    """Answer or narrower interval from the counts at the pivots; whether the sketch between them is the one to go on with."""
    low, high = t.pivots
    t.pivots = None
    if before_low <= t.rank < up_to_low:
        t.answer = low
    elif before_high <= t.rank < up_to_high:
        t.answer = high
    elif up_to_low <= t.rank < before_high:
        t.low, t.high, t.below, t.inside = low, high, up_to_low, before_high - up_to_low
        return True
    elif t.rank < before_low:          # the sketch was off: go on below, with a sketch of that part
        t.high, t.inside = low, before_low - t.below
    else:
        t.inside -= up_to_high - t.below
        t.low, t.below = high, up_to_high
    return False

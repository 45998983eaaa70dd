"""Exponentially weighted mean as native window expressions.

pandas ``ewm(span, adjust=False, ignore_na=False).mean()`` is the recurrence
over the observed (non-null) values of a series

    y_first = x_first
    y_i     = r_i * y_prev + s_i * x_i,   r_i = q^g / (q^g + a),  s_i = a / (q^g + a)

with a = 2 / (span + 1), q = 1 - a and g the number of rows since the previous
observed row (g = 1 gives r = q, s = a).  Null rows repeat the last value.

A recurrence has no window function, but its closed form is a ratio of
running sums.  The running products of ``r`` under- and overflow on long
series, so rows are cut into blocks of ``block`` rows: inside a block the sums
are rebased to the block's first observation (the exponents stay below
``block * |ln q|``, about 73 for span 28), and the value carried into a block
is the same recurrence over the per-block summaries, folded with
``aggregate`` over a short array (one entry per block of the series).

Everything runs in two sorts of one hash partitioning by the series keys: no
extra shuffle, no Python.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_TMP = "__ewm_"
_LR = "__lr_"


def linear_recurrence(df: DataFrame, value: str, keys: Sequence[str], order: str, out: str,
                      r_of_gap, s_of_gap, first_r: float, first_s: float,
                      block: int = 1024, shift: int = 0) -> DataFrame:
    """y_i = r_i * y_prev + s_i * x_i over the observed rows of each series.

    ``r_of_gap`` / ``s_of_gap`` map the gap g (rows since the previous
    observed row, as a Column) to the coefficients; the first observation of a
    series uses ``first_r`` (times an empty carry) and ``first_s``.  Null rows
    repeat the last value; rows before the first observation are null.  The
    sums are rebased per ``block`` rows (see the module note): inside a block
    |sum ln r| stays below ``block * max|ln r|`` per gap-1 step.  ``shift=k``
    returns the value k rows back (on the same sorted window: no extra sort).
    """
    keys = list(keys)
    t = lambda n: _LR + n
    w_row = Window.partitionBy(*keys).orderBy(order)
    x = F.col(value).cast("double")
    obs = x.isNotNull()

    df = df.withColumn(t("rn"), F.row_number().over(w_row))
    df = df.withColumn(
        t("prev"),
        F.last(F.when(obs, F.col(t("rn"))), ignorenulls=True)
         .over(w_row.rowsBetween(Window.unboundedPreceding, -1)))
    rn, prev = F.col(t("rn")), F.col(t("prev"))
    df = df.withColumn(t("blk"), F.floor((rn - 1) / F.lit(block)).cast("long"))
    g = (rn - prev).cast("double")
    first_in_series = obs & prev.isNull()
    first_in_blk = obs & (prev.isNull() | (F.floor((prev - 1) / F.lit(block)) < F.col(t("blk"))))
    r = F.when(first_in_series, F.lit(first_r)).otherwise(r_of_gap(g))
    s_ = F.when(first_in_series, F.lit(first_s)).otherwise(s_of_gap(g))
    df = (df.withColumn(t("r"), F.when(obs, r))
            .withColumn(t("s"), F.when(obs, s_))
            .withColumn(t("fib"), first_in_blk))

    # Same sort for the block window and the series window below:
    # (keys, blk, order); blk is monotone in ``order``.
    w_blk = Window.partitionBy(*keys, t("blk")).orderBy(order)
    cum = w_blk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lr = F.when(obs & ~F.col(t("fib")), F.log(F.col(t("r")))).otherwise(F.lit(0.0))
    df = df.withColumn(t("L"), F.sum(lr).over(cum))
    term = F.when(obs, F.col(t("s")) * x * F.exp(-F.col(t("L"))))
    df = (df.withColumn(t("T"), F.sum(term).over(cum))
            .withColumn(t("rf"), F.first(F.when(F.col(t("fib")), F.col(t("r"))), ignorenulls=True).over(cum))
            .withColumn(t("last"), F.max(rn).over(w_blk.rowsBetween(Window.unboundedPreceding,
                                                                     Window.unboundedFollowing))))
    seen = F.col(t("rf")).isNotNull()
    z = F.exp(F.col(t("L"))) * F.col(t("T"))
    m = F.col(t("rf")) * F.exp(F.col(t("L")))
    df = df.withColumn(t("z"), z).withColumn(t("m"), m).withColumn(t("seen"), seen)

    w_ser = Window.partitionBy(*keys).orderBy(t("blk"), order)
    summary = F.when(rn == F.col(t("last")),
                     F.struct(F.col(t("blk")).alias("b"), F.col(t("seen")).alias("seen"),
                              F.col(t("z")).alias("z"), F.col(t("m")).alias("m")))
    df = df.withColumn(
        t("ends"),
        F.array_sort(F.collect_list(summary).over(
            w_ser.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    cur_blk = F.col(t("blk"))
    carry = F.aggregate(
        F.filter(F.col(t("ends")), lambda e: e["b"] < cur_blk),
        F.lit(None).cast("double"),
        lambda acc, e: F.when(e["seen"], e["z"] + e["m"] * F.coalesce(acc, F.lit(0.0))).otherwise(acc))
    y = F.when(F.col(t("seen")), F.col(t("z")) + F.col(t("m")) * F.coalesce(carry, F.lit(0.0))) \
         .otherwise(carry)
    df = df.withColumn(out, F.lag(y, shift).over(w_ser) if shift else y)
    return df.drop(*[c for c in df.columns if c.startswith(_LR)])


def ewm_adjust_false(df: DataFrame, value: str, keys: Sequence[str], order: str,
                     span: int = 28, out: str = "ewm", shift: int = 1,
                     block: int = 1024) -> DataFrame:
    """Add ``out`` = EWM(span, adjust=False) of ``value`` per series.

    ``shift=1`` returns the value of the previous row (the feature pipeline's
    ``x.shift(1).ewm(...)``: no leakage of the current row).
    """
    a = 2.0 / (span + 1.0)
    ln_q = math.log(1.0 - a)

    def qg(g):
        # q^g via exp(g ln q): underflows to 0 for huge gaps, which is the limit
        return F.exp(g * F.lit(ln_q))

    return linear_recurrence(df, value, keys, order, out,
                             r_of_gap=lambda g: qg(g) / (qg(g) + F.lit(a)),
                             s_of_gap=lambda g: F.lit(a) / (qg(g) + F.lit(a)),
                             first_r=0.0, first_s=1.0, block=block, shift=shift)


def ewm_adjust_true(df: DataFrame, value: str, keys: Sequence[str], order: str,
                    span: int = 28, out: str = "ewm_adj", shift: int = 0,
                    block: int = 512) -> DataFrame:
    """EWM(span, adjust=True) per series, as pandas (``ignore_na=False``).

    The weighted mean with weights (1-a)^age is the ratio of two recurrences
    S_i = q^g S_prev + x_i and W_i = q^g W_prev + 1 over the observed rows
    (ages count null rows too).  ``shift=0`` includes the current row (the
    scorer's value at the latest row).
    """
    a = 2.0 / (span + 1.0)
    ln_q = math.log(1.0 - a)
    num, den, one = _TMP + "num", _TMP + "den", _TMP + "one"
    df = df.withColumn(one, F.when(F.col(value).isNotNull(), F.lit(1.0)))
    rg = lambda g: F.exp(g * F.lit(ln_q))
    df = linear_recurrence(df, value, keys, order, num, rg, lambda g: F.lit(1.0), 0.0, 1.0, block, shift)
    df = linear_recurrence(df, one, keys, order, den, rg, lambda g: F.lit(1.0), 0.0, 1.0, block, shift)
    return df.withColumn(out, F.col(num) / F.col(den)).drop(num, den, one)


def ewm_adjusted_over_array(values: Column, span: int = 28) -> Column:
    """EWM(span, adjust=True) of the last element of a short ordered array.

    weights (1 - a)^age over the non-null entries, age counted in positions
    (nulls age the older values, as pandas ``ignore_na=False`` does).  Meant
    for bounded arrays (the scorer's last-30 history), not whole series.
    """
    a = 2.0 / (span + 1.0)
    q = 1.0 - a
    n = F.size(values)
    idx = F.sequence(F.lit(0), n - 1)
    num = F.aggregate(idx, F.lit(0.0),
                      lambda acc, i: acc + F.coalesce(
                          F.element_at(values, i + 1).cast("double")
                          * F.pow(F.lit(q), (n - 1 - i).cast("double")), F.lit(0.0)))
    den = F.aggregate(idx, F.lit(0.0),
                      lambda acc, i: acc + F.when(F.element_at(values, i + 1).isNotNull(),
                                                  F.pow(F.lit(q), (n - 1 - i).cast("double")))
                                            .otherwise(F.lit(0.0)))
    return F.when(den > 0, num / den)

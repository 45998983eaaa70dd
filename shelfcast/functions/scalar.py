"""Column expressions (JVM-side, codegen friendly). No Python UDFs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfcast import config as C

INF = float("inf")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- rounding (F20, F21) ----------------------------------------------------

def round_half_even(c, digits: int) -> Column:
    """numpy/pandas ``round``: scale, round half to even, unscale.

    ``rint`` rounds ties to even on the scaled double, which is what numpy
    does; Spark's ``round`` (half-up) and ``bround`` (decimal based) differ.
    Infinite values pass through.
    """
    s = float(10 ** digits)
    c = col(c)
    return F.when(F.isnan(c) | (F.abs(c) == INF), c).otherwise(F.rint(c * F.lit(s)) / F.lit(s))


def js_round(c) -> Column:
    """JavaScript ``Math.round``: floor(x + 0.5)."""
    return F.floor(col(c) + F.lit(0.5))


# --- null-preserving clips (P03, P04) ----------------------------------------

def clip_lower(c, lo) -> Column:
    c = col(c)
    return F.when(c < F.lit(lo), F.lit(lo)).otherwise(c)


def clip(c, lo, hi) -> Column:
    c = col(c)
    return F.when(c < F.lit(lo), F.lit(lo)).when(c > F.lit(hi), F.lit(hi)).otherwise(c)


# --- flags and encodings (F05, F06, F09, F10, F11) -----------------------------

def flag(cond: Column) -> Column:
    """Boolean -> 0/1 int; a null comparison gives 0 (pandas semantics)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def encode_by_list(c, values: Sequence[str]) -> Column:
    """Position in ``values`` (0-based); unseen or null -> -1."""
    arr = F.array(*[F.lit(v) for v in values])
    # array_position is 1-based and 0 when absent, so absent -> -1 already;
    # a null input gives null, which the coalesce turns into -1.
    return F.coalesce((F.array_position(arr, col(c)) - F.lit(1)).cast("int"), F.lit(-1))


def encode_by_map(c, mapping: Mapping[str, int]) -> Column:
    """Map lookup; unseen or null -> -1."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(int(v))]
    m = F.create_map(*pairs)
    return F.coalesce(F.try_element_at(m, col(c)), F.lit(-1)).cast("int")


def season_of_month(month_col) -> Column:
    """Season name from a month number."""
    m = col(month_col)
    return (F.when(m.isin(12, 1, 2), "Winter")
             .when(m.isin(3, 4, 5), "Spring")
             .when(m.isin(6, 7, 8), "Summer")
             .when(m.isin(9, 10, 11), "Autumn"))


def weekday_monday0(date_col) -> Column:
    """Day of week with Monday = 0."""
    return F.weekday(col(date_col))


# --- pricing and inventory (F01-F04, F14-F18) ----------------------------------

def price_ratio(price, competitor) -> Column:
    """price / max(competitor, 0.01), null-preserving."""
    return col(price) / clip_lower(competitor, 0.01)


def effective_price(price, discount, unit: str = "percent") -> Column:
    """price * (1 - discount) with discount in percent or fraction."""
    d = col(discount) / F.lit(100.0) if unit == "percent" else col(discount)
    return col(price) * (F.lit(1.0) - d)


def daily_sales(total_sold, days: int = C.N_DAYS) -> Column:
    return col(total_sold).cast("double") / F.lit(float(days))


def days_of_supply(stock, total_sold, days: int = C.N_DAYS) -> Column:
    """stock / daily sales, 2 dp half-even; 0/0 -> 0, x/0 -> +inf."""
    ds = daily_sales(total_sold, days)
    st = col(stock).cast("double")
    raw = (F.when(ds == 0, F.when(st == 0, F.lit(None).cast("double"))
                            .when(st > 0, F.lit(INF)).otherwise(F.lit(-INF)))
           .otherwise(st / ds))
    return F.coalesce(round_half_even(raw, 2), F.lit(0.0))


def sell_through_rate(sold, received) -> Column:
    """sold / received * 100, 2 dp; 0/0 -> null, x/0 -> +inf (F16)."""
    s, r = col(sold).cast("double"), col(received).cast("double")
    raw = (F.when(r == 0, F.when(s == 0, F.lit(None).cast("double"))
                          .when(s > 0, F.lit(INF)).otherwise(F.lit(-INF)))
           .otherwise(s / r * F.lit(100.0)))
    return round_half_even(raw, 2)


def health_class(dos, critical: int = C.CRITICAL_DAYS, low: int = C.LOW_DAYS) -> Column:
    """critical < 14 <= low < 45 <= healthy (+inf healthy)."""
    d = col(dos)
    return F.when(d < critical, "critical").when(d < low, "low").otherwise("healthy")


def safe_div(a, b) -> Column:
    """Division that yields null on a zero divisor (ANSI-safe)."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))

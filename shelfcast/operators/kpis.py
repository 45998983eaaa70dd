"""Inventory KPIs and dashboard roll-ups.

One ``inventory_kpis`` frame answers every store at once; each panel is a
projection, an aggregate or a per-store top-n of it.

Scale: per-store top-n uses ``row_number() <= n`` which Spark plans with a
WindowGroupLimit before the shuffle, so even a store holding a third of the
rows sends at most n rows per map partition.  Full ranked lists are global
``orderBy``s (range partitioning over (store, key, product): a hot store is
split over many ranges).  Aggregates are partial-aggregated map side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast import config as C
from shelfcast.functions import scalar as S


def inventory_kpis(snapshot: DataFrame, days: int = C.N_DAYS, critical: int = C.CRITICAL_DAYS,
                   low: int = C.LOW_DAYS) -> DataFrame:
    """F14-F18 on every snapshot row."""
    return snapshot.withColumns({
        "daily_sales": S.daily_sales("total_units_sold", days),
        "days_of_supply": S.days_of_supply("current_stock", "total_units_sold", days),
        "sell_through_rate": S.sell_through_rate("total_units_sold", "total_units_received"),
        "shrinkage": F.col("total_units_received") - F.col("total_units_sold") - F.col("current_stock"),
    }).withColumn("stock_health", S.health_class("days_of_supply", critical, low))


def filter_store(df: DataFrame, store: str | None) -> DataFrame:
    """Optional store filter, id upper-cased (None = all stores)."""
    if store is None:
        return df
    return df.filter(F.col("store_id") == F.upper(F.lit(store)))


def unknown_stores(requested: DataFrame, snapshot: DataFrame) -> DataFrame:
    """P07 validity: requested store ids (column ``store_id``) that do not exist."""
    req = requested.select(F.upper("store_id").alias("store_id"))
    return req.join(snapshot.select("store_id").distinct(), "store_id", "left_anti")


def stores(snapshot: DataFrame) -> DataFrame:
    """Sorted distinct store ids."""
    return snapshot.select("store_id").distinct().orderBy("store_id")


def top_n(df: DataFrame, n: int, order: Sequence[Column], part: Sequence[str] = ("store_id",),
          tie: Sequence[str] = ("product_id",), rank_col: str = "rank") -> DataFrame:
    """N rows per group by ``order`` with explicit tie-breakers; 1-based rank."""
    w = Window.partitionBy(*part).orderBy(*order, *[F.col(t).asc() for t in tie])
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


# --- ranked lists (O01, O02, O03, O04) -----------------------------------------

def stock_levels(kpis: DataFrame) -> DataFrame:
    """Products by current stock ascending, per store."""
    return (kpis.select("store_id", "product_id", "category", "current_stock", "stock_health")
                .orderBy("store_id", "current_stock", "product_id"))


def sell_through(kpis: DataFrame) -> DataFrame:
    """O02 + F23: sell-through rate descending with its band on the JS-rounded rate."""
    rate = S.js_round("sell_through_rate")
    band = F.when(rate >= 70, "good").when(rate >= 40, "fair").otherwise("poor")
    return (kpis.select("store_id", "product_id", "category", "sell_through_rate",
                        F.col("total_units_sold").alias("total_sold"),
                        F.col("total_units_received").alias("total_received"),
                        band.alias("band"))
                .orderBy("store_id", F.col("sell_through_rate").desc_nulls_last(), "product_id"))


def sell_through_top(kpis: DataFrame, n: int = 12) -> DataFrame:
    """O02 panel: the first ``n`` per store, flagged top and bottom of the shown list."""
    t = top_n(kpis, n, [F.col("sell_through_rate").desc_nulls_last()])
    last = F.max("rank").over(Window.partitionBy("store_id"))
    return t.select("store_id", "product_id", "category", "sell_through_rate", "rank",
                    (F.col("rank") == 1).alias("is_top"), (F.col("rank") == last).alias("is_bottom"))


def days_of_supply_list(kpis: DataFrame) -> DataFrame:
    """Days of supply ascending with the daily sales rounded to 2."""
    return (kpis.select("store_id", "product_id", "category", "days_of_supply", "stock_health",
                        "current_stock", S.round_half_even("daily_sales", 2).alias("daily_sales"))
                .orderBy("store_id", "days_of_supply", "product_id"))


def days_of_supply_scale(kpis: DataFrame) -> DataFrame:
    """O03 bar scale: min(90, max dos) and class counts per store."""
    return kpis.groupBy("store_id").agg(
        F.least(F.lit(90.0), F.max("days_of_supply")).alias("bar_max_days"),
        F.count_if(F.col("stock_health") == "critical").alias("critical"),
        F.count_if(F.col("stock_health") == "low").alias("low"))


def shrinkage_list(kpis: DataFrame) -> DataFrame:
    """O04 + F24: shrinkage descending with its variance band."""
    v = F.col("shrinkage")
    band = (F.when(v > 10, "high").when(v > 0, "surplus").when(v == 0, "balanced")
             .otherwise("anomaly"))
    return (kpis.select("store_id", "product_id", "category",
                        F.col("total_units_received").alias("total_received"),
                        F.col("total_units_sold").alias("total_sold"),
                        "current_stock", "shrinkage", band.alias("variance_band"))
                .orderBy("store_id", F.col("shrinkage").desc(), "product_id"))


# --- aggregates (A05-A11) ---------------------------------------------------------

def stock_levels_summary(kpis: DataFrame) -> DataFrame:
    """Total stock and class counts per store (zero when absent)."""
    return kpis.groupBy("store_id").agg(
        F.sum("current_stock").alias("total_stock"),
        *[F.count_if(F.col("stock_health") == c).alias(c) for c in C.HEALTH_CLASSES])


def stock_health(kpis: DataFrame) -> DataFrame:
    """Count and percent (1 dp) per class in fixed order, zero rows kept.

    Per-store counts are unpivoted into the fixed class list (an array of
    three structs + explode), so zero classes keep their row without a join;
    percentages use the numpy-style half-even rounding (F20).
    """
    per_store = kpis.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("total_products"),
        *[F.count_if(F.col("stock_health") == c).alias(c) for c in C.HEALTH_CLASSES])
    # one row per (store, class): unpivot the three counts (no join needed)
    long = per_store.select(
        "store_id", "total_products",
        F.explode(F.array(*[F.struct(F.lit(i).alias("class_order"), F.lit(c).alias("status"),
                                     F.col(c).alias("count"))
                            for i, c in enumerate(C.HEALTH_CLASSES)])).alias("e")).select(
        "store_id", "total_products", "e.*")
    pct = F.when(F.col("total_products") > 0,
                 S.round_half_even(F.col("count") / F.col("total_products") * F.lit(100.0), 1)) \
           .otherwise(F.lit(0.0))
    return long.withColumn("percentage", pct)


def shrinkage_total(kpis: DataFrame) -> DataFrame:
    """Per-store total shrinkage."""
    return kpis.groupBy("store_id").agg(F.sum("shrinkage").alias("total_shrinkage"))


def category_breakdown(kpis: DataFrame) -> DataFrame:
    """Per store and category: class counts and total (panel sorts by total desc)."""
    return (kpis.groupBy("store_id", "category").agg(
                *[F.count_if(F.col("stock_health") == c).alias(c) for c in C.HEALTH_CLASSES],
                F.count(F.lit(1)).alias("total"))
                .orderBy("store_id", F.col("total").desc(), "category"))


def dos_band(dos) -> Column:
    d = S.col(dos)
    e = None
    for hi, label in C.HEATMAP_BANDS:
        e = F.when(d <= hi, label) if e is None else e.when(d <= hi, label)
    return e.otherwise(C.HEATMAP_LAST_BAND)


def health_heatmap(kpis: DataFrame) -> DataFrame:
    """Products per (store, category, days band) and the category's critical count."""
    cells = kpis.groupBy("store_id", "category", dos_band("days_of_supply").alias("band")) \
                .agg(F.count(F.lit(1)).alias("products"))
    crit = kpis.groupBy("store_id", "category").agg(
        F.count_if(F.col("stock_health") == "critical").alias("critical_in_category"))
    return cells.join(crit, ["store_id", "category"], "inner")


def variance_counts(kpis: DataFrame) -> DataFrame:
    """A10: number of surplus (> 0) and anomaly (< 0) items per store."""
    return kpis.groupBy("store_id").agg(F.count_if(F.col("shrinkage") > 0).alias("surplus_items"),
                                        F.count_if(F.col("shrinkage") < 0).alias("anomaly_items"))


def lead_time_risk_summary(kpis: DataFrame) -> DataFrame:
    """Items whose supply does not cover the lead time; bar scale max(dos, lead, 1)."""
    return kpis.groupBy("store_id").agg(
        F.count_if(F.col("days_of_supply") <= F.col("lead_time_days")).alias("at_risk"),
        F.greatest(F.max(F.greatest(F.col("days_of_supply"), F.col("lead_time_days").cast("double"))),
                   F.lit(1.0)).alias("bar_max_days"))


# --- top-n panels (O05-O09) --------------------------------------------------------

def _gap(kpis: DataFrame) -> Column:
    return F.col("days_of_supply") - F.col("lead_time_days")


def risk_label(gap_rounded) -> Column:
    """F22 on the JS-rounded gap."""
    g = S.col(gap_rounded)
    return F.when(g <= 0, "at_risk").when(g <= 7, "buffer").otherwise("ok")


def lead_time_risk(kpis: DataFrame, n: int = 8) -> DataFrame:
    """N items per store with the smallest (dos - lead) gap, rounded gap and label."""
    t = top_n(kpis.withColumn("gap", _gap(kpis)), n, [F.col("gap").asc()])
    g = S.js_round("gap")
    return t.select("store_id", "product_id", "category", "lead_time_days", "days_of_supply",
                    "stock_health", "rank", g.alias("gap_days"), risk_label(g).alias("risk"))


def risk_spotlight(kpis: DataFrame, n: int = 6) -> DataFrame:
    """Items with dos <= lead, n per store by gap, with the at-risk count."""
    at_risk = kpis.filter(F.col("days_of_supply") <= F.col("lead_time_days")).withColumn("gap", _gap(kpis))
    t = top_n(at_risk, n, [F.col("gap").asc()])
    counts = at_risk.groupBy("store_id").agg(F.count(F.lit(1)).alias("at_risk_items"))
    return t.select("store_id", "product_id", "rank", S.js_round("gap").alias("gap_days"),
                    S.js_round("days_of_supply").alias("supply_days"), "lead_time_days") \
            .join(counts, "store_id", "inner")


def critical_items(kpis: DataFrame, n: int = 12) -> DataFrame:
    """O07 + J05: critical/low items, n lowest dos per store, with lead time and at-risk flag."""
    urgent = kpis.filter(F.col("stock_health").isin("critical", "low"))
    t = top_n(urgent, n, [F.col("days_of_supply").asc()])
    return t.select("store_id", "product_id", "category", "stock_health", "rank",
                    S.js_round("days_of_supply").alias("supply_days"), "lead_time_days",
                    (F.col("days_of_supply") <= F.col("lead_time_days")).alias("stockout_risk"))


def variance_highlights(kpis: DataFrame, n: int = 8) -> DataFrame:
    """The n largest absolute variances per store."""
    t = top_n(kpis, n, [F.abs(F.col("shrinkage")).desc()])
    return t.select("store_id", "product_id", "category", "shrinkage", "rank")


def insight_cards(kpis: DataFrame) -> DataFrame:
    """Per-store arg-max/min cards (top performer, urgent stock-out or lowest
    supply, largest positive variance, best healthy stock): one aggregation by store,
    each card the minimum of a (value, product) struct, so ties go to the smallest product id."""
    def best(cond, value, largest: bool):
        """Product and value of the best row: the smallest (value or its negative, product) struct."""
        order = -value if largest else value
        return F.min(F.when(cond, F.struct(order.alias("k"), F.col("product_id").alias("p"), value.alias("v"))))
    dos, always = F.col("days_of_supply"), F.lit(True)
    g = kpis.groupBy("store_id").agg(
        best(F.col("sell_through_rate").isNotNull(), F.col("sell_through_rate"), True).alias("top"),
        best(F.col("stock_health") == "critical", dos, False).alias("urgent"),
        best(always, dos, False).alias("lowest"),
        best(F.col("shrinkage") > 0, F.col("shrinkage"), True).alias("variance"),
        best(F.col("stock_health") == "healthy", dos, True).alias("healthy"))
    # urgent stock-out card falls back to the lowest supply when no critical item exists
    supply = F.coalesce("urgent", "lowest")
    return g.select(
        "store_id", F.col("top.p").alias("top_product"), S.js_round(F.col("top.v")).alias("top_rate"),
        F.when(F.col("urgent").isNotNull(), F.lit("urgent_stockout")).otherwise(F.lit("lowest_supply")).alias("supply_card"),
        supply["p"].alias("supply_product"), S.js_round(supply["v"]).alias("supply_days"),
        F.col("variance.p").alias("variance_product"), F.col("variance.v").alias("variance_units"),
        F.col("healthy.p").alias("best_product"), S.js_round(F.col("healthy.v")).alias("best_days"))


def health_trend(kpis: DataFrame, ranges: Sequence[tuple[int, int]] = C.TREND_RANGES,
                 critical: int = C.CRITICAL_DAYS, low: int = C.LOW_DAYS) -> DataFrame:
    """class counts per store at n points back in time (dos + days_ago)."""
    pts = []
    for days, n in ranges:
        for i in range(n):
            # JS Math.round(days/(n-1)*(n-1-i)) = floor(x + 0.5)
            x = days / (n - 1) * (n - 1 - i)
            pts.append(F.struct(F.lit(days).alias("timeframe_days"), F.lit(i).alias("point"),
                                F.floor(F.lit(x) + F.lit(0.5)).cast("int").alias("days_ago")))
    e = kpis.select("store_id", "days_of_supply", F.explode(F.array(*pts)).alias("p")).select(
        "store_id", "days_of_supply", "p.*")
    est = F.col("days_of_supply") + F.col("days_ago")
    return e.groupBy("store_id", "timeframe_days", "point", "days_ago").agg(
        F.count_if(est < critical).alias("critical"),
        F.count_if((est >= critical) & (est < low)).alias("low"),
        F.count_if(est >= low).alias("healthy"))


# --- facets and point lookups (A01-A04, P08, P09) ------------------------------------

def _totals() -> list[Column]:
    return [F.sum("current_stock").alias("total_stock"), F.sum("total_units_sold").alias("total_sold"),
            F.sum("total_units_received").alias("total_received")]


def inventory_by_product(snapshot: DataFrame) -> DataFrame:
    return snapshot.groupBy("product_id").agg(*_totals())


def inventory_by_store(snapshot: DataFrame) -> DataFrame:
    return snapshot.groupBy("store_id").agg(*_totals())


def inventory_overall(snapshot: DataFrame) -> DataFrame:
    return snapshot.agg(F.countDistinct("product_id").alias("total_products"),
                        F.countDistinct("store_id").alias("total_stores"), *_totals())


def inventory_facets(snapshot: DataFrame) -> DataFrame:
    """Product, store and overall totals from one scan (GROUPING SETS).

    ``facet`` names the grouping; ``key`` is the product or store id (null
    for the overall row).  One Expand + one shuffle instead of three scans.
    """
    g = snapshot.groupingSets([["product_id"], ["store_id"], []], "product_id", "store_id").agg(
        F.grouping_id().alias("gid"), *_totals())
    facet = F.when(F.col("gid") == 1, "product").when(F.col("gid") == 2, "store").otherwise("overall")
    return g.select(facet.alias("facet"), F.coalesce("product_id", "store_id").alias("key"),
                    "total_stock", "total_sold", "total_received")


def product_lookup(snapshot: DataFrame, product_id: str | None = None, store: str | None = None) -> DataFrame:
    """Point lookup by (upper-cased) ids; None = all."""
    df = snapshot
    if product_id is not None:
        df = df.filter(F.col("product_id") == F.upper(F.lit(product_id)))
    return filter_store(df, store)


def low_stock(snapshot: DataFrame, threshold: int = 10, store: str | None = None) -> DataFrame:
    """Items under a stock threshold, ascending."""
    return (filter_store(snapshot, store).filter(F.col("current_stock") < threshold)
            .select("store_id", "product_id", "category", "current_stock")
            .orderBy("store_id", "current_stock", "product_id"))

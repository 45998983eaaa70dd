"""Queries: inventory KPIs, dashboard panels, facets and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast import config as C
from shelfcast.operators import kpis as K
from shelfcast.plans import tables as TB
from shelfcast.plans.catalog import register
from shelfcast.plans.sqlbase import with_ctes

KP = """
  SELECT s.*, total_units_sold / 365e0 AS daily_sales,
    COALESCE(round_even(CASE WHEN total_units_sold = 0 THEN
        (CASE WHEN current_stock = 0 THEN NULL WHEN current_stock > 0 THEN 'inf'::DOUBLE ELSE '-inf'::DOUBLE END)
      ELSE current_stock / (total_units_sold / 365e0) END, 2), 0e0) AS days_of_supply,
    round_even(CASE WHEN total_units_received = 0 THEN
        (CASE WHEN total_units_sold = 0 THEN NULL WHEN total_units_sold > 0 THEN 'inf'::DOUBLE ELSE '-inf'::DOUBLE END)
      ELSE total_units_sold / total_units_received * 100e0 END, 2) AS sell_through_rate,
    total_units_received - total_units_sold - current_stock AS shrinkage
  FROM inventory_snapshot s
"""
KPIS = """
  SELECT *, CASE WHEN days_of_supply < 14 THEN 'critical' WHEN days_of_supply < 45 THEN 'low'
                 ELSE 'healthy' END AS stock_health FROM kp
"""


def ksql(body: str) -> str:
    return with_ctes("inventory_snapshot", extra=[("kp", KP), ("kpis", KPIS)]) + body


def kpis_df(spark, sf_dir):
    return K.inventory_kpis(TB.snapshot(spark, sf_dir))


def JS(x: str) -> str:
    return f"CAST(floor({x} + 0.5) AS BIGINT)"


def RANK(order: str) -> str:
    return f"CAST(row_number() OVER (PARTITION BY store_id ORDER BY {order}, product_id) AS INTEGER)"


@register("stores", "SELECT DISTINCT store_id FROM (" + with_ctes("inventory_snapshot")
          + "SELECT store_id FROM inventory_snapshot) t")
def q_stores(spark, sf_dir):
    return K.stores(TB.snapshot(spark, sf_dir))


@register("inventory_kpis", ksql("""SELECT store_id, product_id, category, region, current_stock,
  total_units_sold, total_units_received, lead_time_days, daily_sales, days_of_supply, sell_through_rate,
  shrinkage, stock_health FROM kpis"""))
def q_inventory_kpis(spark, sf_dir):
    return kpis_df(spark, sf_dir)


@register("stock_levels", ksql("SELECT store_id, product_id, category, current_stock, stock_health FROM kpis"))
def q_stock_levels(spark, sf_dir):
    return K.stock_levels(kpis_df(spark, sf_dir))


@register("stock_levels_summary", ksql("""SELECT store_id, CAST(SUM(current_stock) AS BIGINT) AS total_stock,
  count_if(stock_health = 'critical') AS critical, count_if(stock_health = 'low') AS low,
  count_if(stock_health = 'healthy') AS healthy FROM kpis GROUP BY store_id"""))
def q_stock_levels_summary(spark, sf_dir):
    return K.stock_levels_summary(kpis_df(spark, sf_dir))


@register("stock_health", ksql("""SELECT store_id, total_products, class_order, status, count,
  CASE WHEN total_products > 0 THEN round_even(count / total_products * 100e0, 1) ELSE 0e0 END AS percentage
FROM (SELECT store_id, COUNT(*) AS total_products, count_if(stock_health = 'critical') AS c0,
             count_if(stock_health = 'low') AS c1, count_if(stock_health = 'healthy') AS c2
      FROM kpis GROUP BY store_id) p,
     LATERAL (SELECT * FROM (VALUES (0, 'critical', p.c0), (1, 'low', p.c1), (2, 'healthy', p.c2))
              v(class_order, status, count)) x"""))
def q_stock_health(spark, sf_dir):
    return K.stock_health(kpis_df(spark, sf_dir))


@register("sell_through", ksql(f"""SELECT store_id, product_id, category, sell_through_rate,
  total_units_sold AS total_sold, total_units_received AS total_received,
  CASE WHEN {JS('sell_through_rate')} >= 70 THEN 'good' WHEN {JS('sell_through_rate')} >= 40 THEN 'fair'
       ELSE 'poor' END AS band FROM kpis"""))
def q_sell_through(spark, sf_dir):
    return K.sell_through(kpis_df(spark, sf_dir))


@register("sell_through_top", ksql(f"""SELECT store_id, product_id, category, sell_through_rate, rank,
  rank = 1 AS is_top, rank = MAX(rank) OVER (PARTITION BY store_id) AS is_bottom
FROM (SELECT *, {RANK('sell_through_rate DESC NULLS LAST')} AS rank FROM kpis) t WHERE rank <= 12"""))
def q_sell_through_top(spark, sf_dir):
    return K.sell_through_top(kpis_df(spark, sf_dir))


@register("days_of_supply", ksql("""SELECT store_id, product_id, category, days_of_supply, stock_health,
  current_stock, round_even(daily_sales, 2) AS daily_sales FROM kpis"""))
def q_days_of_supply(spark, sf_dir):
    return K.days_of_supply_list(kpis_df(spark, sf_dir))


@register("days_of_supply_scale", ksql("""SELECT store_id, LEAST(90e0, MAX(days_of_supply)) AS bar_max_days,
  count_if(stock_health = 'critical') AS critical, count_if(stock_health = 'low') AS low
FROM kpis GROUP BY store_id"""))
def q_days_of_supply_scale(spark, sf_dir):
    return K.days_of_supply_scale(kpis_df(spark, sf_dir))


@register("shrinkage", ksql("""SELECT store_id, product_id, category, total_units_received AS total_received,
  total_units_sold AS total_sold, current_stock, shrinkage,
  CASE WHEN shrinkage > 10 THEN 'high' WHEN shrinkage > 0 THEN 'surplus' WHEN shrinkage = 0 THEN 'balanced'
       ELSE 'anomaly' END AS variance_band FROM kpis"""))
def q_shrinkage(spark, sf_dir):
    return K.shrinkage_list(kpis_df(spark, sf_dir))


@register("shrinkage_total", ksql("""SELECT store_id, CAST(SUM(shrinkage) AS BIGINT) AS total_shrinkage
FROM kpis GROUP BY store_id"""))
def q_shrinkage_total(spark, sf_dir):
    return K.shrinkage_total(kpis_df(spark, sf_dir))


@register("category_breakdown", ksql("""SELECT store_id, category, count_if(stock_health = 'critical') AS critical,
  count_if(stock_health = 'low') AS low, count_if(stock_health = 'healthy') AS healthy, COUNT(*) AS total
FROM kpis GROUP BY store_id, category"""))
def q_category_breakdown(spark, sf_dir):
    return K.category_breakdown(kpis_df(spark, sf_dir))


def _band_sql(x: str) -> str:
    parts = " ".join(f"WHEN {x} <= {hi} THEN '{label}'" for hi, label in C.HEATMAP_BANDS)
    return f"CASE {parts} ELSE '{C.HEATMAP_LAST_BAND}' END"


@register("health_heatmap", ksql(f"""SELECT c.store_id, c.category, band, products, critical_in_category
FROM (SELECT store_id, category, {_band_sql('days_of_supply')} AS band, COUNT(*) AS products
      FROM kpis GROUP BY 1, 2, 3) c
JOIN (SELECT store_id, category, count_if(stock_health = 'critical') AS critical_in_category
      FROM kpis GROUP BY 1, 2) k ON c.store_id = k.store_id AND c.category = k.category"""))
def q_health_heatmap(spark, sf_dir):
    return K.health_heatmap(kpis_df(spark, sf_dir))


@register("variance_counts", ksql("""SELECT store_id, count_if(shrinkage > 0) AS surplus_items,
  count_if(shrinkage < 0) AS anomaly_items FROM kpis GROUP BY store_id"""))
def q_variance_counts(spark, sf_dir):
    return K.variance_counts(kpis_df(spark, sf_dir))


@register("lead_time_risk_summary", ksql("""SELECT store_id, count_if(days_of_supply <= lead_time_days) AS at_risk,
  GREATEST(MAX(GREATEST(days_of_supply, CAST(lead_time_days AS DOUBLE))), 1e0) AS bar_max_days
FROM kpis GROUP BY store_id"""))
def q_lead_time_risk_summary(spark, sf_dir):
    return K.lead_time_risk_summary(kpis_df(spark, sf_dir))


@register("lead_time_risk", ksql(f"""SELECT store_id, product_id, category, lead_time_days, days_of_supply,
  stock_health, rank, {JS('gap')} AS gap_days,
  CASE WHEN {JS('gap')} <= 0 THEN 'at_risk' WHEN {JS('gap')} <= 7 THEN 'buffer' ELSE 'ok' END AS risk
FROM (SELECT *, days_of_supply - lead_time_days AS gap,
             {RANK('days_of_supply - lead_time_days')} AS rank FROM kpis) t WHERE rank <= 8"""))
def q_lead_time_risk(spark, sf_dir):
    return K.lead_time_risk(kpis_df(spark, sf_dir))


@register("risk_spotlight", ksql(f"""SELECT t.store_id, product_id, rank, {JS('gap')} AS gap_days,
  {JS('days_of_supply')} AS supply_days, lead_time_days, at_risk_items
FROM (SELECT *, days_of_supply - lead_time_days AS gap, {RANK('days_of_supply - lead_time_days')} AS rank
      FROM kpis WHERE days_of_supply <= lead_time_days) t
JOIN (SELECT store_id, COUNT(*) AS at_risk_items FROM kpis WHERE days_of_supply <= lead_time_days
      GROUP BY store_id) c ON t.store_id = c.store_id
WHERE rank <= 6"""))
def q_risk_spotlight(spark, sf_dir):
    return K.risk_spotlight(kpis_df(spark, sf_dir))


@register("critical_items", ksql(f"""SELECT store_id, product_id, category, stock_health, rank,
  {JS('days_of_supply')} AS supply_days, lead_time_days, days_of_supply <= lead_time_days AS stockout_risk
FROM (SELECT *, {RANK('days_of_supply')} AS rank FROM kpis WHERE stock_health IN ('critical', 'low')) t
WHERE rank <= 12"""))
def q_critical_items(spark, sf_dir):
    return K.critical_items(kpis_df(spark, sf_dir))


@register("variance_highlights", ksql(f"""SELECT store_id, product_id, category, shrinkage, rank
FROM (SELECT *, {RANK('abs(shrinkage) DESC')} AS rank FROM kpis) t WHERE rank <= 8"""))
def q_variance_highlights(spark, sf_dir):
    return K.variance_highlights(kpis_df(spark, sf_dir))


@register("insight_cards", ksql(f"""SELECT s.store_id, top_product, top_rate,
  CASE WHEN urgent_product IS NOT NULL THEN 'urgent_stockout' ELSE 'lowest_supply' END AS supply_card,
  COALESCE(urgent_product, lowest_product) AS supply_product, COALESCE(urgent_days, lowest_days) AS supply_days,
  variance_product, variance_units, best_product, best_days
FROM (SELECT DISTINCT store_id FROM kpis) s
LEFT JOIN (SELECT store_id, product_id AS top_product, {JS('sell_through_rate')} AS top_rate FROM
   (SELECT *, {RANK('sell_through_rate DESC')} AS r FROM kpis WHERE sell_through_rate IS NOT NULL) t WHERE r = 1) a
  ON s.store_id = a.store_id
LEFT JOIN (SELECT store_id, product_id AS urgent_product, {JS('days_of_supply')} AS urgent_days FROM
   (SELECT *, {RANK('days_of_supply')} AS r FROM kpis WHERE stock_health = 'critical') t WHERE r = 1) b
  ON s.store_id = b.store_id
LEFT JOIN (SELECT store_id, product_id AS lowest_product, {JS('days_of_supply')} AS lowest_days FROM
   (SELECT *, {RANK('days_of_supply')} AS r FROM kpis) t WHERE r = 1) c ON s.store_id = c.store_id
LEFT JOIN (SELECT store_id, product_id AS variance_product, shrinkage AS variance_units FROM
   (SELECT *, {RANK('shrinkage DESC')} AS r FROM kpis WHERE shrinkage > 0) t WHERE r = 1) d
  ON s.store_id = d.store_id
LEFT JOIN (SELECT store_id, product_id AS best_product, {JS('days_of_supply')} AS best_days FROM
   (SELECT *, {RANK('days_of_supply DESC')} AS r FROM kpis WHERE stock_health = 'healthy') t WHERE r = 1) e
  ON s.store_id = e.store_id"""))
def q_insight_cards(spark, sf_dir):
    return K.insight_cards(kpis_df(spark, sf_dir))


def _trend_points_sql() -> str:
    vals = []
    for days, n in C.TREND_RANGES:
        for i in range(n):
            x = days / (n - 1) * (n - 1 - i)
            vals.append(f"({days}, {i}, {x!r})")
    return "(VALUES " + ", ".join(vals) + ") p(timeframe_days, point, x)"


@register("health_trend", ksql(f"""SELECT store_id, timeframe_days, point, days_ago,
  count_if(days_of_supply + days_ago < 14) AS critical,
  count_if(days_of_supply + days_ago >= 14 AND days_of_supply + days_ago < 45) AS low,
  count_if(days_of_supply + days_ago >= 45) AS healthy
FROM kpis, (SELECT CAST(timeframe_days AS INTEGER) AS timeframe_days, CAST(point AS INTEGER) AS point,
                   CAST(floor(x + 0.5) AS INTEGER) AS days_ago FROM {_trend_points_sql()}) pts
GROUP BY 1, 2, 3, 4"""))
def q_health_trend(spark, sf_dir):
    return K.health_trend(kpis_df(spark, sf_dir))


_TOT = ("CAST(SUM(current_stock) AS BIGINT) AS total_stock, CAST(SUM(total_units_sold) AS BIGINT) AS total_sold, "
        "CAST(SUM(total_units_received) AS BIGINT) AS total_received")


@register("inventory_by_product", with_ctes("inventory_snapshot")
          + f"SELECT product_id, {_TOT} FROM inventory_snapshot GROUP BY product_id")
def q_inventory_by_product(spark, sf_dir):
    return K.inventory_by_product(TB.snapshot(spark, sf_dir))


@register("inventory_by_store", with_ctes("inventory_snapshot")
          + f"SELECT store_id, {_TOT} FROM inventory_snapshot GROUP BY store_id")
def q_inventory_by_store(spark, sf_dir):
    return K.inventory_by_store(TB.snapshot(spark, sf_dir))


@register("inventory_overall", with_ctes("inventory_snapshot")
          + f"""SELECT COUNT(DISTINCT product_id) AS total_products, COUNT(DISTINCT store_id) AS total_stores,
  {_TOT} FROM inventory_snapshot""")
def q_inventory_overall(spark, sf_dir):
    return K.inventory_overall(TB.snapshot(spark, sf_dir))


@register("inventory_facets", with_ctes("inventory_snapshot")
          + f"""SELECT CASE WHEN GROUPING(product_id) = 0 THEN 'product' WHEN GROUPING(store_id) = 0 THEN 'store'
  ELSE 'overall' END AS facet, COALESCE(product_id, store_id) AS key, {_TOT}
FROM inventory_snapshot GROUP BY GROUPING SETS ((product_id), (store_id), ())""")
def q_inventory_facets(spark, sf_dir):
    return K.inventory_facets(TB.snapshot(spark, sf_dir))


@register("product_lookup", with_ctes("inventory_snapshot")
          + """SELECT * FROM inventory_snapshot WHERE product_id = upper('p0007')""")
def q_product_lookup(spark, sf_dir):
    return K.product_lookup(TB.snapshot(spark, sf_dir), product_id="p0007")


@register("low_stock", with_ctes("inventory_snapshot")
          + "SELECT store_id, product_id, category, current_stock FROM inventory_snapshot WHERE current_stock < 50")
def q_low_stock(spark, sf_dir):
    return K.low_stock(TB.snapshot(spark, sf_dir), threshold=50)


@register("restock_needs", with_ctes("inventory_snapshot")
          + "SELECT store_id, product_id, category, current_stock FROM inventory_snapshot WHERE current_stock < 100")
def q_restock_needs(spark, sf_dir):
    return K.low_stock(TB.snapshot(spark, sf_dir), threshold=100)


@register("unknown_stores", with_ctes("inventory_snapshot")
          + """SELECT DISTINCT upper('S00' || CAST(o_custkey % 7 + 1 AS VARCHAR)) AS store_id FROM orders
WHERE upper('S00' || CAST(o_custkey % 7 + 1 AS VARCHAR)) NOT IN (SELECT store_id FROM inventory_snapshot)""")
def q_unknown_stores(spark, sf_dir):
    """P07 validity on requested ids (customer-derived, some outside the 5 stores)."""
    from shelfcast.sources.testdata import read_table
    req = read_table(spark, sf_dir, "orders").select(
        F.concat(F.lit("s00"), (F.col("o_custkey") % 7 + 1).cast("string")).alias("store_id"))
    return K.unknown_stores(req, TB.snapshot(spark, sf_dir)).distinct()

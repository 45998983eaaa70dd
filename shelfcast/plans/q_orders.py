"""Queries: vendors, orders, receipts, conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.functions.joins import partitions_for
from shelfcast.operators import conversations as CV
from shelfcast.operators import orders as OR
from shelfcast.plans import tables as TB
from shelfcast.plans.catalog import register
from shelfcast.plans.sqlbase import with_ctes


def order_partitions(spark, sf_dir):
    """Shuffle partitions by order id, from the tables' row counts (Parquet footers)."""
    return partitions_for(spark, max(TB.order_lines(spark, sf_dir).count(), TB.order_headers(spark, sf_dir).count()))


def line_items(spark, sf_dir, partitions=None):
    """Order lines with the order's store (the store comes from the order, not the line)."""
    lines = TB.order_lines(spark, sf_dir).select("order_id", "product_id", "quantity")
    heads = TB.order_headers(spark, sf_dir).select("order_id", "store_id")
    if partitions:
        lines, heads = lines.repartition(partitions, "order_id"), heads.repartition(partitions, "order_id")
    return lines.join(heads, "order_id", "inner")


def order_inputs(spark, sf_dir, snapshot):
    """What the order operators take: lines, snapshot, vendors and the number of partitions by order id."""
    n = order_partitions(spark, sf_dir)
    return line_items(spark, sf_dir, n), snapshot, TB.vendors(spark, sf_dir), n


FIRSTV = """SELECT category, arg_min(name, vendor_id) AS vendor, arg_min(min_order_qty, vendor_id) AS min_qty,
  arg_min(price_per_unit, vendor_id) AS price FROM vendors GROUP BY category"""
LN = """SELECT order_id, upper(h.store_id) AS store_id, upper(product_id) AS product_id,
  CAST(SUM(quantity) AS BIGINT) AS quantity
FROM order_lines l JOIN order_headers h USING (order_id) GROUP BY 1, 2, 3"""
REJ = """SELECT order_id, store_id, COUNT(*) AS unknown_products, MIN(product_id) AS first_unknown_product,
  CAST(SUM(quantity) AS BIGINT) AS unknown_units
FROM ln WHERE NOT EXISTS (SELECT 1 FROM inventory_snapshot s WHERE s.store_id = ln.store_id
                          AND s.product_id = ln.product_id) GROUP BY 1, 2"""
PRICED = """SELECT ln.order_id, ln.store_id, ln.product_id, s.category, ln.quantity,
  COALESCE(v.price, 0e0) AS unit_price, COALESCE(v.vendor, 'Unknown') AS vendor_name,
  ln.quantity * COALESCE(v.price, 0e0) AS subtotal
FROM ln JOIN inventory_snapshot s ON s.store_id = ln.store_id AND s.product_id = ln.product_id
LEFT JOIN firstv v ON v.category = s.category
WHERE ln.order_id NOT IN (SELECT order_id FROM rej)"""
TOTALS = """SELECT h.order_id, upper(h.store_id) AS store_id, COALESCE(t.total_units, 0) AS total_units,
  COALESCE(round_even(t.cost, 2), 0e0) AS total_cost, COALESCE(t.n_items, 0) AS n_items
FROM order_headers h LEFT JOIN (SELECT order_id, CAST(SUM(quantity) AS BIGINT) AS total_units, SUM(subtotal) AS cost,
  COUNT(*) AS n_items FROM priced GROUP BY order_id) t USING (order_id)
WHERE h.order_id NOT IN (SELECT order_id FROM rej)"""


def osql(body: str, upto: str = "totals", partial: bool = False) -> str:
    order = [("firstv", FIRSTV), ("ln", LN), ("rej", REJ), ("priced", PRICED), ("totals", TOTALS)]
    names = [n for n, _ in order]
    extra = order[: names.index(upto) + 1]
    return with_ctes("inventory_snapshot", "vendors", "order_headers", "order_lines", extra=extra, partial=partial) + body


@register("vendors_by_category", with_ctes("vendors") + "SELECT * FROM vendors WHERE category = 'Dairy'")
def q_vendors_by_category(spark, sf_dir):
    return OR.vendors_by_category(TB.vendors(spark, sf_dir), "Dairy")


@register("first_vendor", with_ctes("vendors") + """SELECT category, arg_min(vendor_id, vendor_id) AS vendor_id,
  arg_min(name, vendor_id) AS name, arg_min(lead_time_days, vendor_id) AS lead_time_days,
  arg_min(min_order_qty, vendor_id) AS min_order_qty, arg_min(price_per_unit, vendor_id) AS price_per_unit,
  arg_min(region, vendor_id) AS region, arg_min(rating, vendor_id) AS rating,
  arg_min(contact_email, vendor_id) AS contact_email
FROM vendors GROUP BY category""")
def q_first_vendor(spark, sf_dir):
    return OR.first_vendor_per_category(TB.vendors(spark, sf_dir))


@register("reorder_suggestions", with_ctes("inventory_snapshot", "vendors", extra=[("firstv", FIRSTV)]) + """
SELECT store_id, product_id, s.category, current_stock, COALESCE(vendor, 'N/A') AS vendor,
  COALESCE(min_qty, 0) AS min_qty, COALESCE(price, 0e0) AS price
FROM inventory_snapshot s LEFT JOIN firstv v ON s.category = v.category WHERE current_stock < 100""")
def q_reorder_suggestions(spark, sf_dir):
    return OR.reorder_suggestions(TB.snapshot(spark, sf_dir), TB.vendors(spark, sf_dir))


@register("order_rejects", osql("SELECT * FROM rej", "rej", partial=True))
def q_order_rejects(spark, sf_dir):
    """J04 against a snapshot that misses a series, so that there are unknown products."""
    return OR.rejects_of(OR.evaluate_orders(*order_inputs(spark, sf_dir, TB.partial_snapshot(spark, sf_dir))))


@register("order_pricing", osql("SELECT * FROM priced", "priced"))
def q_order_pricing(spark, sf_dir):
    return OR.order_pricing(*order_inputs(spark, sf_dir, TB.snapshot(spark, sf_dir)))


def _totals_df(spark, sf_dir):
    ev = OR.evaluate_orders(*order_inputs(spark, sf_dir, TB.snapshot(spark, sf_dir)))
    return OR.order_totals(TB.order_headers(spark, sf_dir), ev)


@register("order_totals", osql("SELECT * FROM totals"))
def q_order_totals(spark, sf_dir):
    return _totals_df(spark, sf_dir)


@register("orders_placed", osql("""SELECT t.order_id, t.store_id, t.total_units, t.total_cost, 'completed' AS status,
  h.created_at, CAST(p.pos AS INTEGER) AS pos, p.product_id, p.category, p.quantity, p.unit_price, p.vendor_name
FROM totals t JOIN order_headers h USING (order_id)
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY order_id
             ORDER BY product_id, category, quantity, unit_price, vendor_name) - 1 AS pos FROM priced) p USING (order_id)"""))
def q_orders_placed(spark, sf_dir):
    """Order documents for accepted orders, unnested to one row per item (orders without items: one row)."""
    placed = OR.place_orders(TB.order_headers(spark, sf_dir),
                             *order_inputs(spark, sf_dir, TB.snapshot(spark, sf_dir)))
    return placed.select("order_id", "store_id", "total_units", "total_cost", "status", "created_at",
                         F.posexplode_outer("items").alias("pos", "i")).select("*", "i.*").drop("i")


@register("stock_after_orders", osql("""SELECT s.store_id, s.product_id, s.category, s.region,
  s.current_stock + COALESCE(a.q, 0) AS current_stock, s.total_units_sold,
  s.total_units_received + COALESCE(a.q, 0) AS total_units_received, s.lead_time_days
FROM inventory_snapshot s LEFT JOIN (SELECT store_id, product_id, CAST(SUM(quantity) AS BIGINT) AS q FROM priced
  GROUP BY 1, 2) a ON a.store_id = s.store_id AND a.product_id = s.product_id""", "priced"))
def q_stock_after_orders(spark, sf_dir):
    snap = TB.snapshot(spark, sf_dir)
    return OR.apply_receipts(snap, OR.order_pricing(*order_inputs(spark, sf_dir, snap)))


@register("order_history", osql("""SELECT order_id, store_id, total_units, total_cost, created_at, rank FROM (
  SELECT t.*, h.created_at, CAST(row_number() OVER (PARTITION BY t.store_id ORDER BY h.created_at DESC,
         t.order_id DESC) AS INTEGER) AS rank
  FROM totals t JOIN order_headers h USING (order_id)) x WHERE rank <= 20"""))
def q_order_history(spark, sf_dir):
    t = _totals_df(spark, sf_dir).join(TB.order_headers(spark, sf_dir).select("order_id", "created_at"),
                                       "order_id", "inner")
    return OR.order_history(t).select("order_id", "store_id", "total_units", "total_cost", "created_at", "rank")


# --- conversations -------------------------------------------------------------------

def csql(body: str) -> str:
    return with_ctes("conv_turns") + body


@register("conversation_recent", csql("""SELECT user_id, convo_id, turn, role, text FROM (SELECT *,
  row_number() OVER (PARTITION BY user_id, convo_id ORDER BY turn DESC) AS rk FROM conv_turns) t WHERE rk <= 100"""))
def q_conversation_recent(spark, sf_dir):
    return CV.recent_messages(TB.turns(spark, sf_dir), 100)


@register("conversation_recent_cap3", csql("""SELECT user_id, convo_id, turn, role, text FROM (SELECT *,
  row_number() OVER (PARTITION BY user_id, convo_id ORDER BY turn DESC) AS rk FROM conv_turns) t WHERE rk <= 3"""))
def q_conversation_recent_cap3(spark, sf_dir):
    """X04 with a cap the data reaches (conversations have 2-8 turns)."""
    return CV.recent_messages(TB.turns(spark, sf_dir), 3)


TITLES = """SELECT user_id, convo_id, COALESCE(substring(arg_min(CASE WHEN role = 'user' THEN text END,
  CASE WHEN role = 'user' THEN turn END), 1, 50), 'New Conversation') AS title FROM conv_turns GROUP BY 1, 2"""


@register("conversation_title", csql(TITLES))
def q_conversation_title(spark, sf_dir):
    return CV.conversation_titles(TB.turns(spark, sf_dir))


CONVS = f"""SELECT t.user_id, t.convo_id, title, n_messages,
  t.convo_id = MAX(t.convo_id) OVER (PARTITION BY t.user_id) AS active
FROM ({TITLES}) t JOIN (SELECT user_id, convo_id, COUNT(*) AS n_messages FROM conv_turns GROUP BY 1, 2) n
  ON t.user_id = n.user_id AND t.convo_id = n.convo_id"""


@register("conversation_list", csql(f"""SELECT user_id, convo_id, title, n_messages, active, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY convo_id DESC) AS INTEGER) AS rank FROM ({CONVS}) c)
  x WHERE rank <= 20"""))
def q_conversation_list(spark, sf_dir):
    return CV.conversation_list(CV.conversations(TB.turns(spark, sf_dir))).select(
        "user_id", "convo_id", "title", "n_messages", "active", "rank")


@register("conversation_activate", csql(f"""SELECT c.user_id, c.convo_id,
  CASE WHEN ch.user_id IS NOT NULL THEN COALESCE(c.convo_id = ch.chosen, false) ELSE c.active END AS active
FROM ({CONVS}) c LEFT JOIN (SELECT user_id, arg_min(convo_id, (-n, convo_id)) AS chosen
  FROM (SELECT user_id, convo_id, COUNT(*) AS n FROM conv_turns GROUP BY 1, 2) t GROUP BY user_id) ch
  ON c.user_id = ch.user_id"""))
def q_conversation_activate(spark, sf_dir):
    """Every user switches to their longest conversation (ties: smallest id)."""
    turns = TB.turns(spark, sf_dir)
    convs = CV.conversations(turns)
    longest = convs.groupBy("user_id").agg(
        F.min_by("convo_id", F.struct((-F.col("n_messages")).alias("k"), F.col("convo_id"))).alias("convo_id"))
    return CV.activate(convs, longest).select("user_id", "convo_id", "active")


@register("conversation_replay", csql("""SELECT user_id, convo_id,
  CAST(row_number() OVER (PARTITION BY user_id, convo_id ORDER BY turn) - 1 AS INTEGER) AS pos, role, text
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, convo_id ORDER BY turn DESC) AS rk FROM conv_turns) s
WHERE rk <= 100 AND role IN ('user', 'assistant') AND length(COALESCE(text, '')) > 0"""))
def q_conversation_replay(spark, sf_dir):
    """The replay arrays, one row per message with its position."""
    r = CV.replay_history(CV.recent_messages(TB.turns(spark, sf_dir), 100))
    return r.select("user_id", "convo_id", F.posexplode("messages").alias("pos", "m")).select(
        "user_id", "convo_id", "pos", F.col("m.role").alias("role"), F.col("m.content").alias("text"))

"""DuckDB SQL for the derived retail tables (oracle side).

Same definitions as ``shelfcast.sources.testdata``; every oracle query is a
``WITH`` over these common table expressions and the raw test tables.
"""

from __future__ import annotations

from shelfcast import config as C


def case_map(expr: str, mapping: dict, default: str = "NULL", quote_values: bool = True) -> str:
    parts = []
    for k, v in mapping.items():
        key = f"'{k}'" if isinstance(k, str) else str(k)
        val = f"'{v}'" if (quote_values and isinstance(v, str)) else str(v)
        parts.append(f"WHEN {key} THEN {val}")
    return f"CASE {expr} " + " ".join(parts) + f" ELSE {default} END"


def sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


SEASON_SQL = ("CASE WHEN month(date) IN (12, 1, 2) THEN 'Winter' "
              "WHEN month(date) IN (3, 4, 5) THEN 'Spring' "
              "WHEN month(date) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END")

RETAIL_DAILY = f"""
  SELECT date, store_id, product_id,
         {case_map('product_id', C.PRODUCT_CATEGORIES)} AS category,
         {case_map('store_id', C.STORE_REGIONS)} AS region,
         inventory_level, units_sold, units_ordered, demand_forecast, price, discount,
         {sql_list(C.WEATHER_CONDITIONS)}[CAST(dayofmonth(date) % 5 + 1 AS INTEGER)] AS weather_condition,
         holiday_promotion, competitor_pricing,
         {SEASON_SQL} AS seasonality
  FROM (
    SELECT CAST(l_shipdate AS DATE) AS date,
           'S00' || CAST(l_suppkey % 5 + 1 AS VARCHAR) AS store_id,
           'P' || lpad(CAST(l_partkey % 20 + 1 AS VARCHAR), 4, '0') AS product_id,
           CAST(SUM(l_quantity) AS BIGINT) AS units_sold,
           CAST(SUM(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0e0 END) AS BIGINT) AS inventory_level,
           CAST(SUM(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0e0 END) AS BIGINT) AS units_ordered,
           ROUND(SUM(l_quantity * (1e0 + l_tax)), 2) AS demand_forecast,
           MAX(p_retailprice) AS price,
           MIN(p_retailprice) AS competitor_pricing,
           CAST(ROUND(MAX(l_discount) * 100e0, 0) AS BIGINT) AS discount,
           CAST(MAX(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS INTEGER) AS holiday_promotion
    FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY 1, 2, 3) g
"""

INVENTORY_SNAPSHOT = f"""
  SELECT store_id, product_id,
         {case_map('product_id', C.PRODUCT_CATEGORIES)} AS category,
         {case_map('store_id', C.STORE_REGIONS)} AS region,
         CAST(FLOOR(open_qty * (k % 8) / 10e0) AS BIGINT) AS current_stock,
         total_units_sold, total_units_received,
         CAST((k * 3 + n) % 21 + 1 AS BIGINT) AS lead_time_days
  FROM (
    SELECT 'S00' || CAST(l_suppkey % 5 + 1 AS VARCHAR) AS store_id,
           'P' || lpad(CAST(l_partkey % 20 + 1 AS VARCHAR), 4, '0') AS product_id,
           l_partkey % 20 AS k, l_suppkey % 5 + 1 AS n,
           CAST(SUM(l_quantity) AS BIGINT) AS total_units_received,
           CAST(SUM(CASE WHEN l_returnflag <> 'N' THEN l_quantity ELSE 0e0 END) AS BIGINT) AS total_units_sold,
           SUM(CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN l_quantity ELSE 0e0 END) AS open_qty
    FROM lineitem GROUP BY 1, 2, 3, 4) g
"""
PARTIAL_SNAPSHOT = f"SELECT * FROM ({INVENTORY_SNAPSHOT}) s WHERE NOT (store_id = 'S005' AND product_id = 'P0020')"

VENDORS = f"""
  SELECT s_suppkey AS vendor_id, s_name AS name,
         {sql_list(sorted(set(C.PRODUCT_CATEGORIES.values())))}[CAST(s_suppkey % 10 + 1 AS INTEGER)] AS category,
         CAST(s_suppkey % 14 + 1 AS BIGINT) AS lead_time_days,
         CAST({sql_list(C.MIN_ORDER_QTYS)}[CAST(s_suppkey % 5 + 1 AS INTEGER)] AS BIGINT) AS min_order_qty,
         ABS(s_acctbal) AS price_per_unit,
         {sql_list(C.STORE_REGIONS.values())}[CAST(s_suppkey % 5 + 1 AS INTEGER)] AS region,
         3.5e0 + (s_suppkey % 16) / 10e0 AS rating,
         lower(replace(s_name, '#', '.')) || '@supplier.com' AS contact_email
  FROM supplier
"""

ORDER_HEADERS = """
  SELECT o_orderkey AS order_id, 'S00' || CAST(o_custkey % 5 + 1 AS VARCHAR) AS store_id,
         o_orderdate AS created_at
  FROM orders
"""

ORDER_LINES = """
  SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS partkey, l_suppkey AS suppkey,
         'P' || lpad(CAST(l_partkey % 20 + 1 AS VARCHAR), 4, '0') AS product_id,
         CAST(l_quantity AS BIGINT) AS quantity
  FROM lineitem
"""

CONV_TURNS = """
  SELECT conv_id % 50 AS user_id, conv_id AS convo_id, turn, role, text FROM conversations
"""

CTES = {
    "retail_daily": RETAIL_DAILY,
    "inventory_snapshot": INVENTORY_SNAPSHOT,
    "vendors": VENDORS,
    "order_headers": ORDER_HEADERS,
    "order_lines": ORDER_LINES,
    "conv_turns": CONV_TURNS,
}


def with_ctes(*names: str, extra: list[tuple[str, str]] | None = None, partial: bool = False) -> str:
    """``WITH`` clause over the named base tables plus extra (name, sql) pairs; ``partial``: the snapshot
    with a missing row."""
    tables = CTES | ({"inventory_snapshot": PARTIAL_SNAPSHOT} if partial else {})
    parts = [f"{n} AS ({tables[n]})" for n in names]
    parts += [f"{n} AS ({s})" for n, s in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n"

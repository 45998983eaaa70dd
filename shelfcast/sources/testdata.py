"""Retail tables derived from the TPC-H-like test tables.

The application's own inputs (daily retail rows, an inventory snapshot,
vendors, orders, conversations) are not part of the test data, so they are
derived from ``lineitem``/``part``/``supplier``/``orders``/``conversations``
the same way in Spark (here) and in the DuckDB oracle
(``shelfcast.plans.oracle``).  With k = l_partkey % 20 and
n = l_suppkey % 5 + 1 there are 5 stores x 20 products = 100 series.

Scale notes: ``retail_daily`` is one grouped aggregation over the line table
(partial aggregation before the shuffle, so a hot store/product costs no
more than its share of map-side combine); its output is bounded by
dates x series, not by line volume.  ``part`` is joined without a hint: AQE
picks broadcast or sort-merge from the runtime size.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast import config as C
from shelfcast.functions.scalar import season_of_month

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _store(suppkey: Column) -> Column:
    return F.concat(F.lit("S00"), (suppkey % 5 + 1).cast("string"))


def _product(partkey: Column) -> Column:
    return F.concat(F.lit("P"), F.lpad(((partkey % 20) + 1).cast("string"), 4, "0"))


def _map_lookup(mapping: dict, key: Column) -> Column:
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*pairs), key)


def category_of(product_id: Column) -> Column:
    return _map_lookup(C.PRODUCT_CATEGORIES, product_id)


def region_of(store_id: Column) -> Column:
    return _map_lookup(C.STORE_REGIONS, store_id)


def retail_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows per (date, store, product): lineitem joined with part."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_quantity", "l_tax", "l_returnflag",
        "l_linestatus", "l_discount", "l_shipdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    j = li.join(part, li.l_partkey == part.p_partkey, "inner")
    qty = F.col("l_quantity")
    daily = (j.groupBy(F.col("l_shipdate").cast("date").alias("date"),
                       _store(F.col("l_suppkey")).alias("store_id"),
                       _product(F.col("l_partkey")).alias("product_id"))
              .agg(F.sum(qty).cast("long").alias("units_sold"),
                   F.sum(F.when(F.col("l_returnflag") == "N", qty).otherwise(F.lit(0.0)))
                    .cast("long").alias("inventory_level"),
                   F.sum(F.when(F.col("l_linestatus") == "O", qty).otherwise(F.lit(0.0)))
                    .cast("long").alias("units_ordered"),
                   F.round(F.sum(qty * (F.lit(1.0) + F.col("l_tax"))), 2).alias("demand_forecast"),
                   F.max("p_retailprice").alias("price"),
                   F.min("p_retailprice").alias("competitor_pricing"),
                   F.round(F.max("l_discount") * F.lit(100.0), 0).cast("long").alias("discount"),
                   F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).cast("int")
                    .alias("holiday_promotion")))
    return daily.select(
        "date", "store_id", "product_id",
        category_of(F.col("product_id")).alias("category"),
        region_of(F.col("store_id")).alias("region"),
        "inventory_level", "units_sold", "units_ordered", "demand_forecast", "price",
        "discount",
        F.element_at(F.array(*[F.lit(w) for w in C.WEATHER_CONDITIONS]),
                     (F.dayofmonth("date") % 5 + 1)).alias("weather_condition"),
        "holiday_promotion", "competitor_pricing",
        season_of_month(F.month("date")).alias("seasonality"))


def inventory_snapshot(spark: SparkSession, sf_dir: str, drop_missing: bool = False) -> DataFrame:
    """Current-state row per (store, product).

    ``drop_missing`` leaves out S005 x P0020: the fixture for joins that must
    cope with a series without snapshot row (lead times, order rejects).
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus")
    qty = F.col("l_quantity")
    g = (li.groupBy(_store(F.col("l_suppkey")).alias("store_id"),
                    _product(F.col("l_partkey")).alias("product_id"),
                    (F.col("l_partkey") % 20).alias("k"),
                    (F.col("l_suppkey") % 5 + 1).alias("n"))
           .agg(F.sum(qty).cast("long").alias("total_units_received"),
                F.sum(F.when(F.col("l_returnflag") != "N", qty).otherwise(F.lit(0.0)))
                 .cast("long").alias("total_units_sold"),
                F.sum(F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), qty)
                      .otherwise(F.lit(0.0))).alias("open_qty")))
    snap = g.select(
        "store_id", "product_id",
        category_of(F.col("product_id")).alias("category"),
        region_of(F.col("store_id")).alias("region"),
        F.floor(F.col("open_qty") * (F.col("k") % 8) / F.lit(10.0)).cast("long").alias("current_stock"),
        "total_units_sold", "total_units_received",
        ((F.col("k") * 3 + F.col("n")) % 21 + 1).cast("long").alias("lead_time_days"))
    if drop_missing:
        snap = snap.filter(~((F.col("store_id") == "S005") & (F.col("product_id") == "P0020")))
    return snap


def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One vendor per supplier; category from the sorted category list."""
    cats = sorted(set(C.PRODUCT_CATEGORIES.values()))
    s = read_table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("vendor_id"),
        F.col("s_name").alias("name"),
        F.element_at(F.array(*[F.lit(c) for c in cats]), (F.col("s_suppkey") % 10 + 1).cast("int"))
         .alias("category"),
        (F.col("s_suppkey") % 14 + 1).cast("long").alias("lead_time_days"),
        F.element_at(F.array(*[F.lit(v) for v in C.MIN_ORDER_QTYS]), (F.col("s_suppkey") % 5 + 1).cast("int"))
         .cast("long").alias("min_order_qty"),
        F.abs(F.col("s_acctbal")).alias("price_per_unit"),
        F.element_at(F.array(*[F.lit(r) for r in C.STORE_REGIONS.values()]), (F.col("s_suppkey") % 5 + 1).cast("int"))
         .alias("region"),
        (F.lit(3.5) + (F.col("s_suppkey") % 16) / F.lit(10.0)).alias("rating"),
        F.concat(F.lower(F.replace("s_name", F.lit("#"), F.lit("."))), F.lit("@supplier.com")).alias("contact_email"))


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("order_id"),
                    F.concat(F.lit("S00"), (F.col("o_custkey") % 5 + 1).cast("string")).alias("store_id"),
                    F.col("o_orderdate").alias("created_at"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat order lines (order_id, line, product_id, quantity) — one per lineitem."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("order_id"),
                     F.col("l_linenumber").alias("line_no"),
                     F.col("l_partkey").alias("partkey"),
                     F.col("l_suppkey").alias("suppkey"),
                     _product(F.col("l_partkey")).alias("product_id"),
                     F.col("l_quantity").cast("long").alias("quantity"))


def orders_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order documents: header + array of item structs (sorted line order)."""
    lines = order_lines(spark, sf_dir)
    items = (lines.groupBy("order_id")
                  .agg(F.array_sort(F.collect_list(F.struct(
                       "line_no", "partkey", "suppkey", "quantity", "product_id"))).alias("_items")))
    h = order_headers(spark, sf_dir)
    return (h.join(items, "order_id", "left")
             .select("order_id", "store_id", "created_at",
                     F.coalesce(F.transform("_items", lambda e: F.struct(
                         e["product_id"].alias("product_id"), e["quantity"].alias("quantity"))),
                         F.array().cast("array<struct<product_id:string,quantity:bigint>>")).alias("items")))


def conversation_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "conversations")
    return c.select((F.col("conv_id") % 50).alias("user_id"),
                    F.col("conv_id").alias("convo_id"), "turn", "role", "text")

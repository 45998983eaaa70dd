"""Orders, vendors and receipts.

Batch form of the order tool: every order line of every order is priced by
joins (no per-line lookups).  An order with any line whose product is not
stocked at its store is rejected whole *before* anything is applied (the
source had already applied earlier lines by then; we reject atomically).

Scale: the vendor table is reduced to one row per category (bounded by the
number of categories) before it is broadcast under a checked bound; so is the
snapshot, joined on (store, product) (beyond the bound: a shuffle join); totals
are grouped per order with partial aggregation.  ``partitions`` is the number of
shuffle partitions by order id (``functions.joins.partitions_for`` of the lines;
None: the session's), so that what a task holds does not grow with the lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions import scalar as S
from shelfcast.functions.joins import bounded_broadcast


def first_vendor_per_category(vendors: DataFrame) -> DataFrame:
    """One vendor per category: the smallest vendor id (our deterministic "first match")."""
    cols = [c for c in vendors.columns if c not in ("category",)]
    return (vendors.groupBy("category")
                   .agg(F.min_by(F.struct(*cols), F.col("vendor_id")).alias("v"))
                   .select("category", "v.*"))


def vendors_by_category(vendors: DataFrame, category: str | None = None) -> DataFrame:
    """Vendor list, optionally for one category."""
    return vendors if category is None else vendors.filter(F.col("category") == F.lit(category))


def reorder_suggestions(snapshot: DataFrame, vendors: DataFrame, threshold: int = 100,
                        store: str | None = None) -> DataFrame:
    """Items under ``threshold`` with their category's first vendor (N/A, 0, 0 if none)."""
    low = snapshot.filter(F.col("current_stock") < threshold)
    if store is not None:
        low = low.filter(F.col("store_id") == F.upper(F.lit(store)))
    v = bounded_broadcast(first_vendor_per_category(vendors).select(
        "category", F.col("name").alias("vendor"), F.col("min_order_qty").alias("min_qty"),
        F.col("price_per_unit").alias("price")))
    j = low.join(v, "category", "left")
    return (j.select("store_id", "product_id", "category", "current_stock",
                     F.coalesce("vendor", F.lit("N/A")).alias("vendor"),
                     F.coalesce("min_qty", F.lit(0).cast("long")).alias("min_qty"),
                     F.coalesce("price", F.lit(0.0)).alias("price"))
             .orderBy("store_id", "current_stock", "product_id"))


def _by_order(df: DataFrame, partitions: int | None) -> DataFrame:
    return df.repartition(partitions, "order_id") if partitions else df.repartition("order_id")


def _normalise_lines(lines: DataFrame, partitions: int | None = None) -> DataFrame:
    """Upper-case ids and sum repeated (order, product) lines.

    The lines are hash-partitioned by order id first, so the per-(order,
    product) sum, the order-level window and the per-order totals below all
    run on that one partitioning (order groups are small; a hot store or
    product does not matter).
    """
    upper = lines.select("order_id", F.upper("store_id").alias("store_id"),
                         F.upper("product_id").alias("product_id"), "quantity")
    return (_by_order(upper, partitions)
                 .groupBy("order_id", "store_id", "product_id")
                 .agg(F.sum("quantity").alias("quantity")))


def evaluate_orders(lines: DataFrame, snapshot: DataFrame, vendors: DataFrame,
                    partitions: int | None = None) -> DataFrame:
    """One pass over the order lines: each (order, product) line with its category
    (null when the store does not stock the product), the order's accept flag
    (every line stocked) and its price (first vendor of the category; price 0,
    name Unknown without one).  Rejects, pricing and totals all read this."""
    ln = _normalise_lines(lines, partitions)
    prod = bounded_broadcast(snapshot.select(F.upper("store_id").alias("store_id"),
                                             F.upper("product_id").alias("product_id"), "category"))
    j = _by_order(ln.join(prod, ["store_id", "product_id"], "left"), partitions)
    unknown = F.max(F.col("category").isNull().cast("int")).over(Window.partitionBy("order_id"))
    j = j.withColumn("accepted", unknown == 0)
    v = bounded_broadcast(first_vendor_per_category(vendors).select(
        "category", F.col("price_per_unit").alias("unit_price"), F.col("name").alias("vendor_name")))
    p = j.join(v, "category", "left")
    return p.select("order_id", "store_id", "product_id", "category", "quantity", "accepted",
                    F.when(F.col("category").isNotNull(), F.coalesce("unit_price", F.lit(0.0))).alias("unit_price"),
                    F.when(F.col("category").isNotNull(), F.coalesce("vendor_name", F.lit("Unknown")))
                     .alias("vendor_name"))


def rejects_of(evaluated: DataFrame) -> DataFrame:
    """J04 rejects from evaluated lines: orders with unknown products."""
    bad = evaluated.filter(F.col("category").isNull())
    return bad.groupBy("order_id", "store_id").agg(
        F.count(F.lit(1)).alias("unknown_products"),
        F.min("product_id").alias("first_unknown_product"),
        F.sum("quantity").alias("unknown_units"))


def priced_of(evaluated: DataFrame) -> DataFrame:
    """J04 + F26 priced lines of the accepted orders."""
    ok = evaluated.filter("accepted")
    return ok.select("order_id", "store_id", "product_id", "category", "quantity", "unit_price", "vendor_name",
                     (F.col("quantity") * F.col("unit_price")).alias("subtotal"))


def order_rejects(lines: DataFrame, snapshot: DataFrame, vendors: DataFrame | None = None,
                  partitions: int | None = None) -> DataFrame:
    """J04 rejects: orders with at least one product not stocked at the order's store."""
    ln = _normalise_lines(lines, partitions)
    stocked = snapshot.select(F.upper("store_id").alias("store_id"), F.upper("product_id").alias("product_id"))
    bad = ln.join(stocked, ["store_id", "product_id"], "left_anti")
    return bad.groupBy("order_id", "store_id").agg(
        F.count(F.lit(1)).alias("unknown_products"),
        F.min("product_id").alias("first_unknown_product"),
        F.sum("quantity").alias("unknown_units"))


def order_pricing(lines: DataFrame, snapshot: DataFrame, vendors: DataFrame,
                  partitions: int | None = None) -> DataFrame:
    """J04 + F26: priced lines of accepted orders (unknown vendor: price 0, name Unknown)."""
    return priced_of(evaluate_orders(lines, snapshot, vendors, partitions))


def order_summary(evaluated: DataFrame, with_items: bool = False) -> DataFrame:
    """Per order, in one aggregation over the evaluated lines: accepted (every line
    stocked), total units and cost of the lines, number of lines and (for
    X02) the item structs.  One branch over the lines: no second scan."""
    sub = F.col("quantity") * F.col("unit_price")
    aggs = [F.bool_and("accepted").alias("accepted"), F.sum("quantity").alias("total_units"),
            F.sum(sub).alias("_cost"), F.count(F.lit(1)).alias("n_items")]
    if with_items:
        aggs.append(F.array_sort(F.collect_list(F.struct(
            "product_id", "category", "quantity", "unit_price", "vendor_name"))).alias("items"))
    return evaluated.groupBy("order_id").agg(*aggs)


def order_totals(headers: DataFrame, evaluated: DataFrame) -> DataFrame:
    """Per accepted order total units and cost (round half-even to 2); an order
    without lines totals 0; rejected orders are left out."""
    sm = order_summary(evaluated)
    j = headers.join(sm, "order_id", "left").filter(F.coalesce("accepted", F.lit(True)))
    return j.select("order_id", F.upper("store_id").alias("store_id"),
                    F.coalesce("total_units", F.lit(0).cast("long")).alias("total_units"),
                    F.coalesce(S.round_half_even("_cost", 2), F.lit(0.0)).alias("total_cost"),
                    F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"))


def place_orders(headers: DataFrame, lines: DataFrame, snapshot: DataFrame, vendors: DataFrame,
                 partitions: int | None = None) -> DataFrame:
    """Order documents (header + nested items, totals, status) for accepted orders."""
    sm = order_summary(evaluate_orders(lines, snapshot, vendors, partitions), with_items=True)
    empty = F.array().cast("array<struct<product_id:string,category:string,quantity:bigint,"
                           "unit_price:double,vendor_name:string>>")
    j = headers.join(sm, "order_id", "left").filter(F.coalesce("accepted", F.lit(True)))
    return j.select("order_id", F.upper("store_id").alias("store_id"), F.coalesce("items", empty).alias("items"),
                    F.coalesce("total_units", F.lit(0).cast("long")).alias("total_units"),
                    F.coalesce(S.round_half_even("_cost", 2), F.lit(0.0)).alias("total_cost"),
                    F.lit("completed").alias("status"), "created_at")


def apply_receipts(snapshot: DataFrame, priced: DataFrame) -> DataFrame:
    """Stock and received += accepted quantity per (store, product)."""
    add = priced.groupBy("store_id", "product_id").agg(F.sum("quantity").alias("_add"))
    j = snapshot.join(add, ["store_id", "product_id"], "left")
    a = F.coalesce("_add", F.lit(0).cast("long"))
    return j.withColumns({"current_stock": F.col("current_stock") + a,
                          "total_units_received": F.col("total_units_received") + a}).drop("_add")


def order_history(orders: DataFrame, n: int = 20) -> DataFrame:
    """Newest ``n`` orders per store (created_at desc, then order id desc)."""
    w = Window.partitionBy("store_id").orderBy(F.col("created_at").desc(), F.col("order_id").desc())
    return orders.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def record_contacts(submissions: DataFrame, path: str, user_col: str = "user_id") -> None:
    """Append contact submissions (name, email, subject, message, user) with their time."""
    from shelfcast.sources.writers import append_table
    rec = submissions.select("name", "email", "subject", "message", user_col,
                             F.current_timestamp().alias("created_at"))
    append_table(rec, path)

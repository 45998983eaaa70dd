import datetime as dt
import re

from pyspark.sql import functions as F

from shelfcast.functions import joins
from shelfcast.operators import conversations as CV
from shelfcast.operators import orders as OR
from shelfcast.operators import registry as R
from shelfcast.plans import q_orders


def _snap(spark):
    return spark.createDataFrame([("S001", "P1", "Snacks", 10, 100, 120, 3), ("S001", "P2", "Dairy", 5, 50, 60, 2)],
                                 "store_id string, product_id string, category string, current_stock long, "
                                 "total_units_sold long, total_units_received long, lead_time_days long")


def _vendors(spark):
    return spark.createDataFrame([(2, "B", "Snacks", 3, 50, 2.0), (1, "A", "Snacks", 3, 50, 1.5)],
                                 "vendor_id long, name string, category string, lead_time_days long, "
                                 "min_order_qty long, price_per_unit double")


def test_order_rejected_whole_and_receipts(spark):
    lines = spark.createDataFrame(
        [(1, "s001", "p1", 4), (1, "S001", "P1", 1), (1, "S001", "P2", 2),   # accepted; P1 summed
         (2, "S001", "P1", 7), (2, "S001", "P9", 1)],                          # rejected whole
        "order_id long, store_id string, product_id string, quantity long")
    snap, ven = _snap(spark), _vendors(spark)
    rej = {r["order_id"] for r in OR.order_rejects(lines, snap).collect()}
    assert rej == {2}
    priced = {(r["product_id"]): r for r in OR.order_pricing(lines, snap, ven).collect()}
    assert priced["P1"]["quantity"] == 5 and priced["P1"]["unit_price"] == 1.5   # smallest vendor id
    assert priced["P2"]["vendor_name"] == "Unknown" and priced["P2"]["unit_price"] == 0.0
    after = {r["product_id"]: r for r in OR.apply_receipts(snap, OR.order_pricing(lines, snap, ven)).collect()}
    assert after["P1"]["current_stock"] == 15 and after["P1"]["total_units_received"] == 125
    assert after["P2"]["current_stock"] == 7


def test_order_steps_spread_by_rows_not_by_session(spark, tmp_path, monkeypatch):
    # 60 orders of 3 lines, 20 rows a partition: 9 partitions by order id where the session has 4
    lines = spark.range(180).selectExpr("id div 3 AS l_orderkey", "id % 3 + 1 AS l_linenumber", "id % 20 AS l_partkey",
                                        "id % 5 AS l_suppkey", "CAST(1 AS DOUBLE) AS l_quantity", "'N' AS l_returnflag",
                                        "'O' AS l_linestatus")
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(60).selectExpr("id AS o_orderkey", "id AS o_custkey", "TIMESTAMP'2030-01-01' AS o_orderdate") \
         .write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(10).selectExpr("id AS s_suppkey", "concat('Supplier#', id) AS s_name", "CAST(id AS DOUBLE) AS s_acctbal") \
         .write.parquet(str(tmp_path / "supplier.parquet"))

    def run(query):
        df = query(spark, str(tmp_path))
        rows = sorted(df.collect())
        return rows, df._jdf.queryExecution().executedPlan().toString()
    queries = [q_orders.q_order_pricing, q_orders.q_order_totals, q_orders.q_order_rejects, q_orders.q_orders_placed]
    before = [run(q)[0] for q in queries]
    monkeypatch.setattr(joins.partitions_for, "__defaults__", (20,))
    for query, rows in zip(queries, before, strict=True):
        got, plan = run(query)
        assert got == rows
        # every shuffle by order is spread by the number of lines, and the lines are not shuffled by product
        by_order = re.findall(r"hashpartitioning\((?:l_orderkey|o_orderkey|order_id)#\d+L?, (\d+)\)", plan)
        assert by_order and set(by_order) == {"9"}, query.__name__
        assert not re.search(r"hashpartitioning\(store_id#\d+, product_id#\d+, \d+\)", plan), query.__name__


def test_promotion_and_rollback(spark):
    versions = spark.createDataFrame([("m", 1, "Production", 10.0), ("m", 0, "Archived", 12.0),
                                      ("k", 1, "Production", 10.0)],
                                     "model string, version int, stage string, test_mae double")
    cand = spark.createDataFrame([("m", 2, 9.0), ("k", 2, 9.8), ("new", 1, 5.0)],
                                 "model string, version int, test_mae double")
    out = {(r["model"], r["version"]): r["stage"] for r in R.promote(versions, cand).collect()}
    assert out[("m", 2)] == "Production" and out[("m", 1)] == "Archived"   # 10% better
    assert out[("k", 2)] == "Archived" and out[("k", 1)] == "Production"   # 2% better: not enough
    assert out[("new", 1)] == "Production"                                  # no production yet
    rb = {(r["model"], r["version"]): r for r in R.rollback(R.promote(versions, cand), "m").collect()}
    assert rb[("m", 1)]["stage"] == "Production" and rb[("m", 2)]["stage"] == "Archived"
    assert rb[("k", 1)]["stage"] == "Production" and not rb[("k", 1)]["rolled_back"]


def test_selection_ties_to_preferred(spark):
    m = spark.createDataFrame([("tree", "test", 5.0), ("seasonal", "test", 5.0)],
                              "model string, split string, mae double")
    r = R.select_model(m, ["tree", "seasonal"]).first()
    assert r["winner"] == "tree" and r["improvement_percent"] == 0.0


def test_conversation_titles_caps_and_activation(spark):
    t = spark.createDataFrame([(1, 10, 0, "system", "x"), (1, 10, 1, "user", "a" * 80), (1, 10, 2, "assistant", "b"),
                               (1, 11, 0, "assistant", "only bot"), (2, 20, 0, "user", "hi")],
                              "user_id long, convo_id long, turn long, role string, text string")
    titles = {r["convo_id"]: r["title"] for r in CV.conversation_titles(t).collect()}
    assert titles[10] == "a" * 50 and titles[11] == "New Conversation"
    assert CV.recent_messages(t, 2).filter(F.col("convo_id") == 10).count() == 2
    convs = CV.conversations(t)
    act = {r["convo_id"]: r["active"] for r in convs.collect()}
    assert act == {10: False, 11: True, 20: True}
    ch = spark.createDataFrame([(1, 10), (2, None)], "user_id long, convo_id long")
    act2 = {r["convo_id"]: r["active"] for r in CV.activate(convs, ch).collect()}
    assert act2 == {10: True, 11: False, 20: False}

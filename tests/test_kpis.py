import math

from shelfcast.operators import kpis as K


def _snap(spark, rows):
    return spark.createDataFrame(rows, "store_id string, product_id string, category string, current_stock long, "
                                       "total_units_sold long, total_units_received long, lead_time_days long")


def test_zero_divisions_and_classes(spark):
    rows = [("S1", "P1", "A", 0, 0, 0, 5),      # 0/0 -> dos 0 -> critical, sell-through null
            ("S1", "P2", "A", 10, 0, 10, 5),    # x/0 -> +inf -> healthy
            ("S1", "P3", "B", 100, 3650, 4000, 5),  # 10 days -> critical
            ("S1", "P4", "B", 300, 3650, 4000, 5)]  # 30 days -> low
    k = {r["product_id"]: r for r in K.inventory_kpis(_snap(spark, rows)).collect()}
    assert k["P1"]["days_of_supply"] == 0.0 and k["P1"]["stock_health"] == "critical"
    assert k["P1"]["sell_through_rate"] is None
    assert math.isinf(k["P2"]["days_of_supply"]) and k["P2"]["stock_health"] == "healthy"
    assert k["P3"]["stock_health"] == "critical" and k["P4"]["stock_health"] == "low"
    assert k["P3"]["shrinkage"] == 4000 - 3650 - 100


def test_half_even_percentages_and_zero_rows(spark):
    rows = [("S1", f"P{i}", "A", 0, 0, 0, 1) for i in range(8)]   # all critical
    h = {r["status"]: r for r in K.stock_health(K.inventory_kpis(_snap(spark, rows))).collect()}
    assert h["critical"]["count"] == 8 and h["low"]["count"] == 0 and h["healthy"]["percentage"] == 0.0
    rows = [("S1", f"P{i}", "A", 0, 0, 0, 1) for i in range(16)] + [("S1", "Q", "A", 10, 0, 10, 1)]
    pct = {r["status"]: r["percentage"] for r in K.stock_health(K.inventory_kpis(_snap(spark, rows))).collect()}
    assert pct["healthy"] == round(1 / 17 * 100, 1)


def test_top_n_per_store_and_ties(spark):
    rows = [("S1", f"P{i:02d}", "A", 5, 365, 400, 10) for i in range(20)]
    t = K.lead_time_risk(K.inventory_kpis(_snap(spark, rows)), n=8).orderBy("rank").collect()
    assert [r["product_id"] for r in t] == [f"P{i:02d}" for i in range(8)]
    assert all(r["risk"] == "at_risk" for r in t)


def test_facets_one_scan(spark):
    rows = [("S1", "P1", "A", 1, 2, 3, 1), ("S2", "P1", "A", 4, 5, 6, 1)]
    f = {(r["facet"], r["key"]): r for r in K.inventory_facets(_snap(spark, rows)).collect()}
    assert f[("product", "P1")]["total_stock"] == 5 and f[("overall", None)]["total_received"] == 9


def test_scoring_features_use_fractions_and_autumn(spark):
    import datetime as dt

    from shelfcast.operators import scoring as SC
    hist = spark.createDataFrame([(dt.date(2031, 10, i + 1), "S1", "P1", 10 + i, 100.0, 80.0, 20, 1, 9.0, "Autumn")
                                  for i in range(10)], "date date, store_id string, product_id string, units_sold long, "
                                 "price double, competitor_pricing double, discount long, holiday_promotion int, "
                                 "demand_forecast double, seasonality string")
    r = SC.scoring_features(hist, _snap(spark, [("S1", "P1", "Dairy", 5, 1, 1, 3)]).withColumn(
        "region", K.F.lit("West")), discount_unit="percent").first()
    assert r["effective_price"] == 80.0 and r["discount"] == 0.2 and r["discount_x_holiday"] == 0.2
    assert r["seasonality_enc"] == 3


def test_slice_names_are_the_encoders(spark):
    from shelfcast.operators import bias as B
    rows = [(c, 10.0 + c, 10.0) for c in (-1, 0, 1, 4) for _ in range(12)]
    df = spark.createDataFrame(rows, "category_enc int, y double, pred double")
    got = {r["slice_val"] for r in B.model_slice_bias(df, "pred").collect()}
    assert got == {"Unknown", "Groceries", "Snacks", "Personal Care"}


def test_insight_cards_ties_and_fallback(spark):
    rows = [("S1", f"P{i}", "A", 200, 3650, 3900, 5) for i in range(3)] + [("S2", "P1", "A", 900, 365, 1300, 5)]
    c = {r["store_id"]: r for r in K.insight_cards(K.inventory_kpis(_snap(spark, rows))).collect()}
    assert c["S1"]["top_product"] == "P0" and c["S1"]["supply_product"] == "P0" and c["S1"]["variance_units"] == 50
    assert c["S2"]["supply_card"] == "lowest_supply" and c["S2"]["best_product"] == "P1"

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from shelfcast.operators import features as FE

COLS = ["date", "store_id", "product_id", "category", "region", "units_sold", "inventory_level",
        "units_ordered", "demand_forecast", "price", "discount", "holiday_promotion", "competitor_pricing",
        "seasonality"]


def _retail(spark, n_days=60, series=(("A7", "K1"), ("A7", "K2"), ("B9", "K1")), seed=11):
    """Daily rows of our own making: a weekly wave per series, with an out-of-stock day and a price cut each month."""
    rng = np.random.default_rng(seed)
    rows = []
    for n, (s, p) in enumerate(series):
        wave = 60 + 25 * n + 15 * np.sin(np.arange(n_days) * 2 * np.pi / 7)
        units = np.maximum(0, np.round(wave + rng.normal(0, 6, n_days))).astype(int)
        for i in range(n_days):
            cut = 20 if i % 30 == 12 else 0
            rows.append((dt.date(2031, 3, 5) + dt.timedelta(days=i), s, p, "Snacks", "East", int(units[i]),
                         0 if i % 30 == 20 else int(300 - units[i]), int(units[i] // 2), float(wave[i] * 1.1),
                         12.5 + n, cut, int(cut > 0), 13.0 + n, "Spring"))
    schema = ("date date, store_id string, product_id string, category string, region string, units_sold long, "
              "inventory_level long, units_ordered long, demand_forecast double, price double, discount long, "
              "holiday_promotion int, competitor_pricing double, seasonality string")
    return spark.createDataFrame(rows, schema)


def _snap(spark, rows=(("A7", "K1", 3), ("A7", "K2", 8))):
    return spark.createDataFrame(list(rows), "store_id string, product_id string, lead_time_days long")


def test_shape_and_nulls(spark):
    out = FE.features_v2(_retail(spark), _snap(spark)).toPandas()
    assert list(out.columns) == [c for c in FE.C.FINAL_COLS]
    # 60 days - 28 warm-up - 1 label per series
    assert len(out) == 3 * 31
    feats = [c for c in FE.C.FEATURE_COLS if c != "sales_roll_std_7"]
    assert out[feats].isnull().sum().sum() == 0


def test_median_fill_for_missing_snapshot_row(spark):
    out = FE.features_v2(_retail(spark), _snap(spark)).toPandas()
    # store B9 has no snapshot row: median over joined rows of (3, 8) weighted equally = 5.5
    assert set(out.loc[out.store_id == "B9", "lead_time_days"]) == {5.5}


def test_series_isolation_and_no_leakage(spark):
    r = _retail(spark)
    base = FE.features_v2(r, _snap(spark)).toPandas().set_index(["store_id", "product_id", "as_of_date"])
    # changing the future of one series must not change features at or before a date
    days = sorted({i[2] for i in base.index})
    cut = days[len(days) // 2]
    r2 = r.withColumn("units_sold", F.when(F.col("date") > cut, F.col("units_sold") * 7)
                                     .otherwise(F.col("units_sold")))
    other = FE.features_v2(r2, _snap(spark)).toPandas().set_index(["store_id", "product_id", "as_of_date"])
    feats = [c for c in FE.C.FEATURE_COLS]
    early = [i for i in base.index if i[2] <= cut]
    assert len(early) >= 20 and len(early) < len(base)
    late = [i for i in base.index if i[2] > cut]
    assert not base.loc[late, feats].equals(other.loc[late, feats])  # the change is seen where it may be
    pd.testing.assert_frame_equal(base.loc[early, feats], other.loc[early, feats])
    # within a series: lag-1 two rows on equals the label (next value) of this row
    for (s, p), g in base.reset_index().groupby(["store_id", "product_id"]):
        g = g.sort_values("as_of_date")
        assert (g["y"].values[:-2] == g["sales_lag_1"].values[2:]).all()


def test_label_is_next_row_and_differs_from_lag(spark):
    out = FE.features_v2(_retail(spark), _snap(spark)).toPandas()
    g = out[(out.store_id == "A7") & (out.product_id == "K1")].sort_values("as_of_date")
    assert (g["y"].values[:-2] == g["sales_lag_1"].values[2:]).all()
    assert not (g["y"] == g["sales_lag_1"]).all()


def test_small_inputs(spark):
    assert FE.features_v2(_retail(spark, n_days=20), _snap(spark)).count() == 0
    assert FE.features_v2(_retail(spark, n_days=5), _snap(spark)).count() == 0
    assert FE.features_v2(_retail(spark, n_days=60), _snap(spark), horizon=30).count() >= 0


def test_deterministic_under_repartition(spark):
    r = _retail(spark)
    a = FE.features_v2(r, _snap(spark), include_created_at=False).toPandas()
    b = FE.features_v2(r.repartition(7), _snap(spark), include_created_at=False).toPandas()
    key = ["store_id", "product_id", "as_of_date"]
    pd.testing.assert_frame_equal(a.sort_values(key).reset_index(drop=True),
                                  b.sort_values(key).reset_index(drop=True))


def test_dedup_keeps_first_and_clip_keeps_nulls(spark):
    rows = [(dt.date(2022, 1, 1), "S1", "P1", 5, 0), (dt.date(2022, 1, 1), "S1", "P1", 9, 1),
            (dt.date(2022, 1, 2), "S1", "P1", -4, 2), (dt.date(2022, 1, 3), "S1", "P1", None, 3)]
    df = spark.createDataFrame(rows, "date date, store_id string, product_id string, units_sold long, o long")
    for method in ("series", "aggregate"):
        d = FE.dedup_keep_first(df, order_col="o", method=method)
        got = {r["date"]: r["units_sold"] for r in d.collect()}
        assert got[dt.date(2022, 1, 1)] == 5 and len(got) == 3
    c = FE.clip_negatives(df.withColumn("inventory_level", F.lit(-1).cast("long"))).orderBy("o").collect()
    assert [r["units_sold"] for r in c] == [5, 9, 0, None]
    assert all(r["inventory_level"] == 0 for r in c)


def test_windows_vs_pandas(spark):
    r = _retail(spark)
    out = FE.features_v2(r, _snap(spark)).toPandas()
    pdf = r.toPandas().sort_values(["store_id", "product_id", "date"])
    gs = pdf.groupby(["store_id", "product_id"])["units_sold"]
    pdf["m7"] = gs.transform(lambda x: x.rolling(7, min_periods=3).mean().shift(1))
    pdf["s7"] = gs.transform(lambda x: x.rolling(7, min_periods=3).std().shift(1))
    pdf["e"] = gs.transform(lambda x: x.shift(1).ewm(span=28, adjust=False).mean())
    m = out.merge(pdf, left_on=["store_id", "product_id", "as_of_date"], right_on=["store_id", "product_id", "date"])
    assert np.allclose(m["sales_roll_mean_7"], m["m7"])
    assert np.allclose(m["sales_roll_std_7"], m["s7"])
    assert np.allclose(m["sales_ewm_28"], m["e"])


def test_conflicting_duplicates_are_decided_by_ingest_order(spark, tmp_path):
    from shelfcast.sources import readers as RD
    pdf = _retail(spark, series=(("A7", "K1"),)).toPandas()
    again = pdf.copy()
    again["units_sold"] += 1000                         # a second, conflicting delivery of every row
    p = str(tmp_path / "retail")
    spark.createDataFrame(pdf).coalesce(1).write.parquet(p + "/a")
    spark.createDataFrame(again).coalesce(1).write.parquet(p + "/b")
    raw = RD.read_table(spark, p + "/a", RD.RETAIL_SCHEMA, ingest_order=True).unionByName(
        RD.read_table(spark, p + "/b", RD.RETAIL_SCHEMA, ingest_order=True)).repartition(5)
    got = FE.features_v2(raw, _snap(spark), include_created_at=False, order_col="_ingest").toPandas()
    exp = FE.features_v2(spark.createDataFrame(pdf), _snap(spark), include_created_at=False).toPandas()
    assert "_ingest" not in got.columns and len(got) == len(exp) > 0
    assert got.sort_values("as_of_date")["sales_lag_1"].tolist() == exp.sort_values("as_of_date")["sales_lag_1"].tolist()

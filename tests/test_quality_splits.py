import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from shelfcast.operators import quality as Q
from shelfcast.operators import splits as SP


def test_outliers_match_numpy(spark):
    rng = np.random.default_rng(5)
    y = rng.normal(100, 10, 2000)
    y[:5] = 400
    pdf = pd.DataFrame({"y": y, "price": 3.0, "units_sold": [None] * 2000})
    df = spark.createDataFrame(pdf, "y double, price double, units_sold double")
    o = {r["column"]: r for r in Q.outliers(df).collect()}
    z = np.abs((y - y.mean()) / y.std()) > 3
    lo, hi = np.percentile(y, 0.1), np.percentile(y, 99.9)
    p = (y > hi) | (y < lo)
    assert o["y"]["z_score_outliers"] == z.sum() and o["y"]["percentile_outliers"] == p.sum()
    assert o["y"]["outlier_count"] == (z | p).sum()
    assert o["price"]["z_score_outliers"] == 0            # zero variance: no z outliers
    assert "units_sold" not in o                          # all null: skipped


def test_missingness_and_gaps(spark):
    rows = [(dt.date(2022, 1, d), "S1", "P1", None if d % 2 else 1.0) for d in (1, 2, 4, 10, 11)]
    df = spark.createDataFrame(rows, "as_of_date date, store_id string, product_id string, x double")
    m = {r["column"]: r for r in Q.missingness(df).collect()}
    assert m["x"]["null_count"] == 2 and m["x"]["severity"] == "high"
    g = Q.date_gaps(df).first()
    assert g["gap_count"] == 2 and g["max_gap_days"] == 6 and g["total_days"] == 5


def test_split_and_folds_arithmetic(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(400)]
    df = spark.createDataFrame([(d, "S1") for d in days], "as_of_date date, store_id string")
    s = SP.chronological_split(df).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in s} == {"train": 320, "val": 40, "test": 40}
    f = SP.walk_forward_folds(df).orderBy("fold_number").collect()
    step = (399 - 74) // 5
    assert [r["train_end"] for r in f] == [days[0] + dt.timedelta(days=step * i) for i in range(1, 6)]
    assert f[0]["n_train"] == step + 1 and f[0]["n_val"] == 60


def test_folds_with_other_parameters(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(300)]
    df = spark.createDataFrame([(d, "S1") for d in days], "as_of_date date, store_id string")
    f = SP.walk_forward_folds(df, n_splits=3, gap_days=7, val_days=20).orderBy("fold_number").collect()
    step = (299 - 27) // 3
    assert [r["train_end"] for r in f] == [days[0] + dt.timedelta(days=step * i) for i in (1, 2, 3)]
    for r in f:
        assert (r["val_start"] - r["train_end"]).days == 7 and (r["val_end"] - r["val_start"]).days <= 20
        assert r["n_train"] == (r["train_end"] - days[0]).days + 1
        assert r["n_val"] == (r["val_end"] - r["val_start"]).days


def test_quantiles_of_tied_values_collect_nothing(spark):
    from shelfcast.functions import quantiles as QT
    df = spark.range(200_000).select(F.when(F.col("id") % 100 == 0, F.col("id").cast("double")).otherwise(F.lit(7.25)).alias("x"))
    x = np.where(np.arange(200_000) % 100 == 0, np.arange(200_000), 7.25)
    got = QT.exact_quantiles(df, "x", [0.001, 0.5, 0.9995], max_in_bracket=500, accuracy=100)
    assert np.allclose(got, np.quantile(x, [0.001, 0.5, 0.9995]))


def test_dense_index_is_sorted_position(spark):
    ids = [f"S{i % 7}_P{i:04d}" for i in range(500)]
    df = spark.createDataFrame([(x,) for x in ids], "series_id string")
    got = {r["series_id"]: r["code"] for r in SP.dense_index(df, "series_id", partitions=5).collect()}
    exp = {s: i for i, s in enumerate(sorted(set(ids)))}
    assert got == exp


def test_scaler_matches_population_std(spark):
    pdf = pd.DataFrame({"sales_lag_1": [1.0, 2.0, 4.0, None], "inventory_level": [5.0, 5.0, 5.0, 5.0]})
    df = spark.createDataFrame(pdf)
    st = SP.scaler_stats(df)
    out = SP.apply_scaler(df, st).toPandas()
    x = pdf["sales_lag_1"]
    exp = (x - x.mean()) / x.std(ddof=0)
    assert np.allclose(out["sales_lag_1"].dropna(), exp.dropna())
    assert (out["inventory_level"] == 0).all()           # zero std -> divide by 1


def test_exact_quantiles_match_numpy(spark):
    from shelfcast.functions.quantiles import exact_quantiles
    rng = np.random.default_rng(9)
    x = rng.normal(50, 20, 20000).round(3)
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    got = exact_quantiles(df, "x", [0.001, 0.5, 0.999], max_in_bracket=500, accuracy=200)
    exp = np.percentile(x, [0.1, 50, 99.9])
    assert np.allclose(got, exp, rtol=0, atol=1e-9)


def test_all_ranks_in_few_scans(spark):
    from shelfcast.functions.quantiles import quantiles_and_scans
    rng = np.random.default_rng(8)
    n = 300_000
    pdf = pd.DataFrame({"x": rng.normal(size=n), "ties": rng.integers(0, 5, n).astype(float), "long": np.exp(rng.normal(size=n) * 4)})
    pdf["mixed"] = np.where(rng.random(n) < 0.4, 7.0, pdf["x"] * 10)
    pdf.loc[rng.random(n) < 0.01, "x"] = np.nan
    df = spark.createDataFrame(pdf).repartition(6)
    probs = [0.0, 0.001, 0.25, 0.5, 0.7777, 0.999, 1.0]
    got, scans = quantiles_and_scans(df, list(pdf.columns), probs, max_in_bracket=100)
    for c in pdf.columns:
        want = np.percentile(pdf[c].dropna(), [100 * p for p in probs])
        assert np.allclose(got[c], want, rtol=1e-12, atol=0), c
    assert scans <= 4
    # coarse pivots that miss their rank still end, with the same answer
    some = pdf.head(5000)
    rough, _ = quantiles_and_scans(spark.createDataFrame(some), ["x", "mixed"], [0.31], max_in_bracket=3, accuracy=10**9)
    for c in ("x", "mixed"):
        assert np.isclose(rough[c][0], np.percentile(some[c].dropna(), 31), rtol=1e-12)

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.functions import scalar as S
from shelfcast.functions.quantiles import exact_quantiles
from shelfcast.operators import bias as B
from shelfcast.operators import features as FE
from shelfcast.operators import splits as SP


def test_js_and_half_even_rounding(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (0.5,), (-0.5,), (12.25,), (2.675,)], "x double")
    r = df.select("x", S.js_round("x").alias("js"), S.round_half_even("x", 1).alias("he1")).collect()
    js = {row["x"]: row["js"] for row in r}
    assert js[2.5] == 3 and js[-2.5] == -2 and js[0.5] == 1 and js[-0.5] == 0     # Math.round
    he = {row["x"]: row["he1"] for row in r}
    assert he[12.25] == float(np.round(12.25, 1)) and he[2.675] == float(np.round(2.675, 1))


def test_rolling_windows_with_nulls_match_pandas(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 50, 120).astype(float)
    x[rng.random(120) < 0.25] = np.nan
    pdf = pd.DataFrame({"store_id": "S1", "product_id": "P1", "d": np.arange(120), "units_sold": x})
    df = spark.createDataFrame(pdf).withColumn("date", F.date_add(F.lit("2020-01-01").cast("date"), F.col("d").cast("int")))
    w = Window.partitionBy("store_id", "product_id").orderBy("date")
    got = df.select("d", FE._roll("units_sold", 7, 3, w, F.avg).alias("m"),
                    FE._roll("units_sold", 7, 3, w, F.stddev_samp).alias("s")).orderBy("d").toPandas()
    em = pdf["units_sold"].rolling(7, min_periods=3).mean().shift(1)
    es = pdf["units_sold"].rolling(7, min_periods=3).std().shift(1)
    assert (got["m"].isna() == em.isna()).all() and np.allclose(got["m"].dropna(), em.dropna())
    ok = es.notna()
    assert np.allclose(got.loc[ok, "s"], es[ok])


def test_r2_is_one_minus_sse_over_sst(spark):
    rng = np.random.default_rng(8)
    y = rng.integers(0, 30, 200).astype(float)
    p = y + rng.normal(0, 3, 200)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "prediction": p}))
    m = B.regression_metrics(df).first()
    r2 = 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert abs(m["r2"] - round(r2, 4)) < 1e-12 and m["n"] == 200
    assert abs(m["mae"] - round(np.abs(y - p).mean(), 4)) < 1e-12
    pos = y > 0
    assert abs(m["mape"] - round(np.abs((y[pos] - p[pos]) / y[pos]).mean() * 100, 4)) < 1e-9


def test_quantile_edges(spark):
    one = spark.createDataFrame([(3.5,)], "x double")
    assert exact_quantiles(one, "x", [0.001, 0.999]) == [3.5, 3.5]
    const = spark.createDataFrame([(2.0,)] * 5000, "x double")
    assert exact_quantiles(const, "x", [0.5], max_in_bracket=10, accuracy=100) == [2.0]
    empty = spark.createDataFrame([], "x double")
    assert exact_quantiles(empty, "x", [0.5]) == [None]


def test_dense_index_with_a_hot_value(spark):
    ids = ["hot"] * 3000 + [f"id{i:03d}" for i in range(300)]
    df = spark.createDataFrame([(x,) for x in ids], "k string")
    got = {r["k"]: r["code"] for r in SP.dense_index(df, "k", "code", partitions=7).collect()}
    assert got == {k: i for i, k in enumerate(sorted(set(ids)))}

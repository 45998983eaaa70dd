import numpy as np
import pandas as pd
import pytest

from shelfcast.functions.ewm import ewm_adjust_false, ewm_adjusted_over_array
from pyspark.sql import functions as F


def _frame(seed=3, n=300, series=3, null_share=0.15):
    rng = np.random.default_rng(seed)
    rows = []
    for s in range(series):
        x = rng.integers(0, 200, n).astype(float)
        x[rng.random(n) < null_share] = np.nan
        if s == 1:
            x[:4] = np.nan          # leading nulls
        if s == 2:
            x[50:180] = np.nan      # a long gap
        rows += [(s, i, None if np.isnan(v) else float(v)) for i, v in enumerate(x)]
    return pd.DataFrame(rows, columns=["k", "d", "v"])


@pytest.mark.parametrize("block", [1024, 16, 5])
def test_ewm_matches_pandas_with_nulls(spark, block):
    pdf = _frame()
    exp = pdf.groupby("k")["v"].transform(lambda x: x.shift(1).ewm(span=28, adjust=False).mean()).values
    got = (ewm_adjust_false(spark.createDataFrame(pdf), "v", ["k"], "d", block=block)
           .toPandas().sort_values(["k", "d"])["ewm"].values.astype(float))
    assert (np.isnan(exp) == np.isnan(got)).all()
    assert np.nanmax(np.abs(exp - got)) < 1e-9


def test_ewm_long_series_no_overflow(spark):
    n = 12000
    x = np.random.default_rng(0).integers(0, 500, n).astype(float)
    pdf = pd.DataFrame({"k": 0, "d": np.arange(n), "v": x})
    exp = pdf["v"].shift(1).ewm(span=28, adjust=False).mean().values
    got = (ewm_adjust_false(spark.createDataFrame(pdf), "v", ["k"], "d")
           .toPandas().sort_values("d")["ewm"].values.astype(float))
    assert np.isfinite(got[1:]).all()
    assert np.nanmax(np.abs(exp - got)) < 1e-8


def test_ewm_adjusted_array_matches_pandas(spark):
    vals = [3.0, None, 7.0, 1.0, 9.0, 4.0]
    exp = pd.Series(vals, dtype=float).ewm(span=28).mean().iloc[-1]
    df = spark.createDataFrame([(vals,)], "a array<double>")
    got = df.select(ewm_adjusted_over_array(F.col("a")).alias("e")).first()["e"]
    assert abs(got - exp) < 1e-12


@pytest.mark.parametrize("block", [512, 7])
def test_ewm_adjusted_matches_pandas(spark, block):
    from shelfcast.functions.ewm import ewm_adjust_true
    pdf = _frame(seed=11, n=400)
    exp = pdf.groupby("k")["v"].transform(lambda x: x.ewm(span=28).mean()).values
    got = (ewm_adjust_true(spark.createDataFrame(pdf), "v", ["k"], "d", block=block)
           .toPandas().sort_values(["k", "d"])["ewm_adj"].values.astype(float))
    assert (np.isnan(exp) == np.isnan(got)).all()
    assert np.nanmax(np.abs(exp - got)) < 1e-9

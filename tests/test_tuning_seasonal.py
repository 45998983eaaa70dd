"""The seasonal model recovers what was planted; the search resumes, prunes and finds good parameters."""

import datetime as dt
import os
import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from shelfcast.operators import forecast as FC
from shelfcast.operators import seasonal as SE
from shelfcast.operators import tuning as TU


def test_lasso_solves_its_conditions():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(80, 12))
    y = a[:, :3] @ [2.0, -1.0, 0.5] + rng.normal(size=80) * 0.1
    l1, l2 = np.where(np.arange(12) < 2, 0.0, 8.0), np.full(12, 0.1)
    x = SE.lasso(a.T @ a, a.T @ y, l1, l2, np.zeros(12))
    slope = a.T @ y - a.T @ a @ x - l2 * x        # zero where nothing is penalised, within l1 where x is 0, else at its border
    assert np.abs(slope[:2]).max() < 1e-6
    for j in range(2, 12):
        assert abs(slope[j] - l1[j] * np.sign(x[j])) < 1e-6 if x[j] else abs(slope[j]) <= l1[j] + 1e-6
    assert (x == 0).sum() >= 5


def _series(breaks=(300, 700), slopes=(0.02, -0.05, 0.06), n=1000, mult=True, noise=0.3, seed=3):
    rng = np.random.default_rng(seed)
    days = np.arange(n, dtype=float)
    g, level = np.empty(n), 30.0
    for i in range(n):
        g[i] = level
        level += slopes[sum(i >= b for b in breaks)]
    season = 0.3 * np.sin(2 * np.pi * days / 7) + 0.2 * np.cos(2 * np.pi * days / 365.25)
    x = rng.integers(0, 2, (n, 1)).astype(float)
    effect = season + 0.25 * x[:, 0]
    y = g * (1 + effect) if mult else g + 20 * effect
    return days, np.maximum(y + rng.normal(size=n) * noise, 0), x


def test_planted_breaks_are_found():
    days, y, x = _series()
    got = SE.fit_one(days, y, x, {"changepoint_prior_scale": 0.02, "n_changepoints": 39, "changepoint_range": 0.95})
    places, changes = np.array(got["changepoints"]) * got["span"], np.array(got["changes"])
    large = np.abs(changes) > 0.25 * np.abs(changes).max()
    assert all(np.abs(places[large] - b).min() < 40 for b in (300, 700))
    assert all(min(abs(p - b) for b in (300, 700)) < 60 for p in places[large])
    assert (np.abs(changes) < 1e-9).mean() > 0.5    # most possible breaks are none


def _frame(spark, series):
    rows = []
    start = dt.date(2020, 1, 1)
    for i, (days, y, x) in enumerate(series):
        for d, v, r in zip(days, y, x[:, 0]):
            split = "train" if d < 0.8 * len(days) else "val" if d < 0.9 * len(days) else "test"
            rows.append(("S1", f"P{i}", start + dt.timedelta(days=int(d)), split, float(v), float(r)))
    return spark.createDataFrame(rows, "store_id string, product_id string, as_of_date date, split string, y double, holiday_promotion double")


def test_multiplicative_series_need_the_multiplicative_model(spark):
    df = _frame(spark, [_series(seed=s, noise=0.5, breaks=(200, 450), slopes=(0.06, 0.02, 0.09)) for s in range(3)]).cache()
    regs = ["holiday_promotion"]
    mae = lambda p: p.filter("split = 'test'").agg(F.avg(F.abs(F.col("y") - F.col("prediction")))).first()[0]
    errors = {m: mae(SE.forecast(df, {"seasonality_mode": m}, regs)) for m in ("multiplicative", "additive")}
    ridge = mae(FC.fit_predict_series(df, regressors=regs))
    assert errors["multiplicative"] < 0.5 * errors["additive"] and errors["multiplicative"] < 0.5 * ridge


def test_scoring_expression_equals_the_fitted_values(spark):
    days, y, x = _series(n=400, breaks=(150,), slopes=(0.05, -0.02))
    df = _frame(spark, [(days, y, x)])
    for mode in ("multiplicative", "additive"):
        coefficients = SE.fit_series(df.filter("split = 'train'"), {"seasonality_mode": mode}, ["holiday_promotion"])
        path = os.path.join(tempfile.mkdtemp(prefix="seasonal-"), "coefficients")
        coefficients.write.parquet(path)
        stored = spark.read.parquet(path)
        c = stored.first().asDict()
        t = days / c["span"]
        effects = np.hstack([SE._fourier(days), (x - c["means"]) / c["deviations"]]) @ np.array(c["effects"])
        trend = c["level"] + c["slope"] * t + np.maximum(0, t[:, None] - np.array(c["changepoints"])) @ np.array(c["changes"])
        want = np.maximum(0, c["scale"] * (trend * (1 + effects) if mode == "multiplicative" else trend + effects))
        got = SE.predict_series(stored, df, ["holiday_promotion"]).orderBy("as_of_date").toPandas()
        assert np.allclose(got["prediction"], want, atol=1e-8) and c["n_train"] == 320


def test_short_and_flat_series(spark):
    flat = (np.arange(60.0), np.full(60, 5.0), np.zeros((60, 1)))
    zero = (np.arange(60.0), np.zeros(60), np.zeros((60, 1)))
    short = (np.arange(20.0), np.ones(20), np.zeros((20, 1)))
    out = SE.forecast(_frame(spark, [flat, zero, short]), regressors=["holiday_promotion"]).toPandas()
    assert set(out["product_id"]) == {"P0", "P1"}
    assert np.allclose(out[out["product_id"] == "P0"]["prediction"], 5, atol=0.1)
    assert np.allclose(out[out["product_id"] == "P1"]["prediction"], 0, atol=1e-6)


SPACE = {"a": ("float", -5.0, 5.0), "b": ("log", 0.001, 10.0), "c": ("int", 1, 20), "m": ("choice", ("x", "y", "z"))}


def loss(p, rung=0):
    return (p["a"] - 1.5) ** 2 + (np.log10(p["b"]) + 1) ** 2 + 0.05 * (p["c"] - 7) ** 2 + (0 if p["m"] == "y" else 2) + 0.01 * rung


def test_units_round_trip():
    for spec in SPACE.values():
        for u in np.linspace(0, 1, 23):
            v = TU.from_unit(spec, float(u))
            assert TU.from_unit(spec, TU.to_unit(spec, v)) == v or abs(TU.from_unit(spec, TU.to_unit(spec, v)) - v) < 1e-9


def test_search_prunes_resumes_and_beats_random(spark):
    base = tempfile.mkdtemp(prefix="search-")
    calls = []

    def evaluate(trials, rung):
        calls.append((rung, [n for n, _ in trials]))
        return {n: loss(p, rung) for n, p in trials}
    whole = TU.search(spark, os.path.join(base, "a"), SPACE, evaluate, rungs=5).orderBy("trial").collect()
    assert len(whole) == 50 and sum(r["rungs"] for r in whole) == sum(len(ns) for _, ns in calls) < 125 < 250
    states = pd.Series([r["state"] for r in whole]).value_counts()
    assert states["COMPLETE"] == 7 and states["PRUNED"] == 43
    best = min(r["mae"] for r in whole if r["state"] == "COMPLETE")
    rng = np.random.default_rng(42)
    random = min(np.mean([loss({k: TU.from_unit(s, rng.random()) for k, s in SPACE.items()}, 2)]) for _ in range(50))
    assert best <= random

    # killed in the middle of a batch: the second run asks only for what the table lacks
    class Killed(Exception):
        pass
    done = list(calls)
    calls.clear()

    def dies(trials, rung):
        if len(calls) == 11:
            raise Killed
        return evaluate(trials, rung)
    path = os.path.join(base, "b")
    try:
        TU.search(spark, path, SPACE, dies, rungs=5)
        raise AssertionError("it was to be killed")
    except Killed:
        pass
    assert calls == done[:11]
    calls.clear()
    again = TU.search(spark, path, SPACE, evaluate, rungs=5).orderBy("trial").collect()
    assert calls == done[11:] and [r["mae"] for r in again] == [r["mae"] for r in whole]
    calls.clear()
    assert TU.search(spark, path, SPACE, evaluate, rungs=5).count() == 50 and calls == []


def test_failed_trials_leave(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="search-"), "t")
    got = TU.search(spark, path, SPACE, lambda ts, rung: {n: None if n % 2 else loss(p) for n, p in ts}, rungs=3, n_trials=16, batch=4)
    rows = got.collect()
    assert {r["state"] for r in rows if r["trial"] % 2} == {"FAIL"} and all(r["mae"] is None for r in rows if r["trial"] % 2)
    assert sum(r["state"] == "COMPLETE" for r in rows) == 4


def _folds_frame(spark, n=500, products=2):
    rng = np.random.default_rng(2)
    rows = []
    for p in range(products):
        days, y, x = _series(n=n, breaks=(200,), slopes=(0.03, 0.01), seed=p)
        for d, v, r in zip(days, y, x[:, 0]):
            rows.append((f"S1_P{p}", "S1", f"P{p}", dt.date(2020, 1, 1) + dt.timedelta(days=int(d)), float(v), float(r), float(rng.normal())))
    return spark.createDataFrame(rows, "series_id string, store_id string, product_id string, as_of_date date, y double, "
                                       "holiday_promotion double, noise double")


def test_seasonal_search_over_folds(spark):
    df = _folds_frame(spark)
    path = os.path.join(tempfile.mkdtemp(prefix="search-"), "t")
    got = TU.search_seasonal(df, path, n_trials=4, batch=4, n_folds=2, regressors=["holiday_promotion"]).collect()
    assert sorted(r["rungs"] for r in got) == [1, 1, 2, 2] and {r["state"] for r in got} == {"COMPLETE", "PRUNED"}
    # a trial's first rung equals a direct fit on the first fold
    rows = FC.fold_inputs(df, 2)[0][1]
    first = spark.read.parquet(os.path.join(path, "batch=0", "rung=0")).filter("trial = 0").first()
    params = {k: TU.typed(SE.SPACE[k], v) for k, v in first["params"].items()}
    fitted = SE.fit_series(rows.filter("role = 'train'"), params, ["holiday_promotion"])
    want = SE.predict_series(fitted, rows.filter("role = 'val'"), ["holiday_promotion"]).agg(F.avg(F.abs(F.col("y") - F.col("prediction")))).first()[0]
    assert abs(first["mae"] - want) < 1e-9


def test_tree_search_over_folds(spark):
    space = {"maxDepth": ("int", 2, 3), "stepSize": ("log", 0.2, 0.5), "maxIter": ("int", 3, 6), "featureSubsetStrategy": ("float", 0.7, 1.0)}
    path = os.path.join(tempfile.mkdtemp(prefix="search-"), "t")
    got = TU.search_trees(_folds_frame(spark, n=260, products=1), ["holiday_promotion", "noise"], path, n_trials=2, batch=2, n_folds=2, space=space)
    rows = got.collect()
    assert TU.fits(got) == 3 and sorted(r["state"] for r in rows) == ["COMPLETE", "PRUNED"] and all(r["mae"] > 0 for r in rows)
    assert set(rows[0]["params"]) == set(space)

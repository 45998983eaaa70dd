import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from shelfcast.operators import forecast as FC
from shelfcast.operators import intent as IN
from shelfcast.plans import q_models


def _series_frame(spark, n=200, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for s in ("S1", "S2"):
        for i in range(n):
            d = dt.date(2021, 1, 1) + dt.timedelta(days=i)
            split = "train" if i < 160 else ("val" if i < 180 else "test")
            x = float(rng.integers(0, 2))
            y = 20 + 5 * np.sin(2 * np.pi * i / 7) + 3 * x + rng.normal(0, 1)
            rows.append((s, "P1", d, split, float(y), x, float(rng.uniform(1, 5))))
    return spark.createDataFrame(rows, "store_id string, product_id string, as_of_date date, split string, "
                                       "y double, holiday_promotion double, price_vs_competitor double")


def _ridge_by_hand(pdf, regs, ridge=1.0, hinges=25, upto=0.8, weekly=3, yearly=10):
    """The model's definition solved another way: least squares with penalty rows (the intercept is free)."""
    pdf = pdf.sort_values("as_of_date")
    train = (pdf["split"] == "train").to_numpy()
    days = np.array([d.toordinal() for d in pdf["as_of_date"]], float)
    years = (days - days[train].min()) / 365.25
    last = years[train].max()
    columns = [np.ones(len(pdf)), years]
    columns += [np.where(years > k, years - k, 0) for k in [(i + 1) * upto * last / (hinges + 1) for i in range(hinges)]]
    for period, order in ((7 / 365.25, weekly), (1.0, yearly)):
        for k in range(1, order + 1):
            columns += [np.sin(2 * np.pi * k * years / period), np.cos(2 * np.pi * k * years / period)]
    for r in regs:
        x = pdf[r].to_numpy(float)
        columns.append((x - x[train].mean()) / (x[train].std() or 1.0))
    a = np.stack(columns, axis=1)
    penalty = np.sqrt(ridge) * np.diag([0.0] + [1.0] * (a.shape[1] - 1))
    y = pdf["y"].to_numpy(float).clip(min=0)
    coef = np.linalg.lstsq(np.vstack([a[train], penalty]), np.concatenate([y[train], np.zeros(a.shape[1])]), rcond=None)[0]
    return pd.Series((a @ coef).clip(min=0), index=pdf.index)


def test_unseen_series_are_coded_minus_one_inside_a_fold(spark):
    start = dt.date(2021, 1, 1)
    rows = [(f"S1_P{p}", "S1", f"P{p}", start + dt.timedelta(days=i), float(i), float(p + i))
            for p, first in ((1, 0), (2, 0), (3, 230)) for i in range(first, 400)]
    df = spark.createDataFrame(rows, "series_id string, store_id string, product_id string, as_of_date date, "
                                     "sales_lag_1 double, y double")
    folds = FC.fold_inputs(df, n_folds=3)
    assert len(folds) >= 2
    for _, fold in folds:
        pdf = fold.toPandas()
        tr = pdf[pdf["role"] == "train"]
        known = set(tr["series_id"])
        assert set(pdf[~pdf["series_id"].isin(known)]["series_enc"]) <= {-1}
        assert abs(tr["sales_lag_1"].mean()) < 1e-9 and abs(tr["sales_lag_1"].std(ddof=0) - 1) < 1e-9
    first = folds[0][1].toPandas()
    assert "S1_P3" not in set(first[first["role"] == "train"]["series_id"])


def test_series_ridge_equals_direct_numpy_fit(spark):
    df = _series_frame(spark)
    regs = ["holiday_promotion", "price_vs_competitor"]
    got = FC.fit_predict_series(df, regressors=regs).filter(F.col("store_id") == "S1").toPandas()
    pdf = df.filter(F.col("store_id") == "S1").toPandas()
    pdf["prediction_e"] = _ridge_by_hand(pdf, regs)
    m = got.merge(pdf[["as_of_date", "prediction_e"]], on="as_of_date")
    assert np.allclose(m["prediction"], m["prediction_e"], atol=1e-6)
    test = m[m["split"] == "test"]
    naive = np.abs(test["y"].values[1:] - test["y"].values[:-1]).mean()
    assert np.abs(test["y"] - test["prediction"]).mean() < naive      # beats the naive lag-1 baseline


def test_series_tuning_trials_are_consistent(spark):
    df = _series_frame(spark)
    t = FC.tune_series(df, n_trials=3, regressors=["holiday_promotion"]).orderBy("trial").toPandas()
    assert list(t["trial"]) == [0, 1, 2] and (t["state"] == "COMPLETE").all()
    # the trial's MAE equals a direct refit with its parameters
    p = dict(FC.SERIES_DEFAULTS, **{k: v for k, v in t.loc[0, "params"].items()})
    errs = []
    for s in ("S1", "S2"):
        pdf = df.filter(F.col("store_id") == s).toPandas()
        r = FC._fit_predict(pdf, p, ["holiday_promotion"], 30)
        v = r[r["split"] == "val"]
        errs += list(np.abs(v["y"] - v["prediction"]))
    assert abs(np.mean(errs) - t.loc[0, "mae"]) < 1e-9


def test_gbt_and_permutation_importance_find_the_signal(spark):
    rng = np.random.default_rng(1)
    n = 3000
    sig, noise = rng.normal(0, 1, n), rng.normal(0, 1, n)
    pdf = pd.DataFrame({"store_id": "S1", "product_id": [f"P{i % 50}" for i in range(n)],
                        "as_of_date": [dt.date(2020, 1, 1) + dt.timedelta(days=i // 50) for i in range(n)],
                        "sig": sig, "noise": noise, "y": 10 + 5 * sig + rng.normal(0, 0.1, n)})
    df = spark.createDataFrame(pdf)
    model = FC.fit_gbt(df, None, ["sig", "noise"], {"maxIter": 20, "maxDepth": 3, "stepSize": 0.3}, weight=None)
    imp = FC.permutation_importance(model, df, ["sig", "noise"]).collect()
    assert imp[0]["feature"] == "sig" and imp[0]["mae_increase"] > 1.0
    assert FC.feature_importance(model, ["sig", "noise"]).first()["feature"] == "sig"
    pred = FC.predict(model, df, ["sig", "noise"])
    assert pred.filter(F.col("prediction") < 0).count() == 0
    assert "predicted_demand" in pred.columns


def test_router_fits_its_examples(spark):
    model = IN.train_router(spark)
    texts = spark.createDataFrame([(t, l) for t, l in IN.TRAINING_EXAMPLES], "text string, label int")
    out = IN.route(model, texts).toPandas()
    acc = (out["intent"] == out["label"].map(lambda i: IN.LABELS[i])).mean()
    assert acc >= 0.9


def test_tree_random_search_trials(spark):
    rng = np.random.default_rng(2)
    rows = []
    for p in range(4):
        for i in range(220):
            sig = float(rng.normal())
            rows.append(("S1", f"P{p}", dt.date(2021, 1, 1) + dt.timedelta(days=i), sig, float(rng.normal()),
                         10 + 3 * sig + float(rng.normal(0, 0.2))))
    df = spark.createDataFrame(rows, "store_id string, product_id string, as_of_date date, sig double, "
                                     "noise double, y double")
    space = {"maxDepth": (2, 4), "stepSize": (0.1, 0.3), "subsamplingRate": (0.8, 1.0),
             "minInstancesPerNode": (1, 3), "minInfoGain": (0.0, 0.0), "maxIter": (5, 10)}
    t = FC.tune_gbt(df, ["sig", "noise"], n_trials=2, n_folds=2, space=space).orderBy("trial").toPandas()
    assert list(t["trial"]) == [0, 1] and (t["state"] == "COMPLETE").all()
    assert set(t.loc[0, "params"]) == set(space) and (t["mae"] > 0).all()


def _fold_frame(spark):
    rng = np.random.default_rng(4)
    rows = []
    for p in range(3):
        for i in range(220):
            sig = float(rng.normal())
            rows.append(("S1", f"P{p}", dt.date(2021, 1, 1) + dt.timedelta(days=i), None if i % 9 == 0 else sig, i % 2 == 0,
                         0.5 + p, 10 + 3 * sig + float(rng.normal(0, 0.2))))
    return spark.createDataFrame(rows, "store_id string, product_id string, as_of_date date, sig double, even boolean, "
                                       "sample_weight double, y double")


def test_walk_forward_metrics_equal_fit_and_predict(spark):
    feats, params = ["sig", "absent", "even"], {"maxIter": 5, "maxDepth": 3, "stepSize": 0.3}
    folds = FC.fold_inputs(_fold_frame(spark), 2)
    want = []
    for f, rows in folds:
        va = rows.filter(F.col("role") == "val")
        pred = FC.predict(FC.fit_gbt(rows.filter(F.col("role") == "train"), va, feats, params), va, feats)
        want.append((f, *FC.regression_metrics(pred).first()))
    for given in (folds, [(f, FC.fold_vectors(rows, feats)) for f, rows in folds]):
        got = FC.walk_forward_eval(folds[0][1], feats, params, folds=given).orderBy("fold_number").collect()
        assert [tuple(r) for r in got] == want


def test_tree_search_prepares_a_fold_once_for_all_trials(spark, monkeypatch):
    seen, whole = [], FC.walk_forward_eval

    def watched(train, features, params, folds):
        seen.append([(f, id(rows), rows.is_cached, sorted(rows.columns)) for f, rows in folds])
        return whole(train, features, params, folds=folds)
    monkeypatch.setattr(FC, "walk_forward_eval", watched)
    space = {"maxDepth": (2, 3), "maxIter": (2, 3), "minInstancesPerNode": (1, 3)}
    before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    assert FC.tune_gbt(_fold_frame(spark), ["sig", "even"], n_trials=3, n_folds=2, space=space).count() == 3
    assert len(seen) == 3 and seen[0] == seen[1] == seen[2] and [f for f, *_ in seen[0]] == [1, 2]
    assert all(kept and names == ["features", "is_val", "sample_weight", "y"] for _, _, kept, names in seen[0])
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() <= before


def test_registered_tree_search_covers_the_whole_budget(spark, sf_dir, monkeypatch):
    asked = []

    def counted(train, features, params, folds):  # the fits themselves are tested above
        asked.append((params, [f for f, _ in folds]))
        return train.sparkSession.createDataFrame([(1.0,)], "mae double")
    monkeypatch.setattr(FC, "walk_forward_eval", counted)
    t = q_models.q_gbt_tuning(spark, sf_dir).toPandas()
    assert sorted(t["trial"]) == list(range(50)) and len(asked) == 50
    assert all(len(folds) == 5 for _, folds in asked)
    depth, trees = ({p[k] for p, _ in asked} for k in ("maxDepth", "maxIter"))
    assert min(depth) >= 3 and max(depth) > 8 and min(trees) >= 100 and max(trees) > 700


def test_router_is_better_than_chance_on_unseen_examples(spark):
    # 30 examples of three labels: measured 0.57 over five folds, chance is 0.33
    assert IN.cross_validated_accuracy(spark) >= 0.5

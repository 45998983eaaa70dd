"""Stored models: one transform for learning and scoring, patience, missing values, attribution."""

import datetime as dt
import itertools
import math
import os
import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from shelfcast import config as C
from shelfcast.operators import attribution as AT
from shelfcast.operators import boosting as BO
from shelfcast.operators import features as FE
from shelfcast.operators import model_store as MS
from shelfcast.operators import registry as R
from shelfcast.operators import splits as SP
from shelfcast.plans import q_models as QM
from shelfcast.plans import tables as TB

KEYS = ["store_id", "product_id", "as_of_date"]
PARAMS = {"maxIter": 12, "maxDepth": 3, "stepSize": 0.2}


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    retail, snap = TB.retail(spark, sf_dir).cache(), TB.snapshot(spark, sf_dir).cache()
    features = FE.features_v2(retail, snap, include_created_at=False).cache()
    return retail, snap, features


@pytest.fixture(scope="module")
def fitted(spark, tables):
    sp = SP.chronological_split(tables[2]).cache()
    part = {s: sp.filter(F.col("split") == s) for s in ("train", "val", "test")}
    return MS.fit_pipeline(part["train"], part["val"], params=PARAMS), part


def test_scored_rows_equal_training_rows(spark, tables):
    retail, snap, features = tables
    # as of a day in the middle: each series' last row is a row that the whole table learns from
    rows = features.select("store_id", "product_id", "as_of_date").orderBy("as_of_date").collect()
    day = rows[2 * len(rows) // 3]["as_of_date"]
    scored = FE.features_v2(retail.filter(F.col("date") <= F.lit(day)), snap, include_created_at=False, rows="latest")
    names = [c for c in C.TRAIN_FEATURES if c != "series_enc"] + ["series_id", "horizon"]
    a = scored.select(*KEYS, *names).toPandas().set_index(KEYS).sort_index()
    b = features.select(*KEYS, *names).toPandas().set_index(KEYS).sort_index()
    both = a.index.intersection(b.index)
    assert len(both) >= 50 and a.index.droplevel(2).is_unique
    pd.testing.assert_frame_equal(a.loc[both], b.loc[both], check_dtype=False)
    assert set(C.TRAIN_FEATURES) - {"series_enc"} <= set(names) and len(C.TRAIN_FEATURES) == 28


def test_stored_pipeline_predicts_as_the_fitted_one(spark, fitted):
    pipeline, part = fitted
    root = tempfile.mkdtemp(prefix="models-")
    MS.save(spark, pipeline, root, "tree", 3, features=C.TRAIN_FEATURES)
    stored = MS.load(spark, root, "tree", 3)
    assert stored.meta["version"] == 3 and stored.meta["code_maps"]["region_codes"] == C.REGION_CODES
    test = part["test"].withColumn("series_id", F.when(F.col("product_id") == "P0003", "S9_P9").otherwise(F.col("series_id")))
    a = MS.score(pipeline, test).select(*KEYS, "series_enc", "prediction").toPandas().set_index(KEYS).sort_index()
    b = MS.score(stored.pipeline, test).select(*KEYS, "series_enc", "prediction").toPandas().set_index(KEYS).sort_index()
    pd.testing.assert_frame_equal(a, b)
    assert set(a.xs("P0003", level=1)["series_enc"]) == {-1} and (a["prediction"] >= 0).all()


def test_stages_equal_the_tables_they_were_made_from(fitted):
    pipeline, part = fitted
    _m, _t, coded = SP.encode_series(part["train"], part["val"])
    want = SP.apply_scaler(coded, SP.scaler_stats(part["train"])).select(*KEYS, "series_enc", *C.SCALED_COLUMNS).toPandas()
    got = PipelineModel(pipeline.stages[:2]).transform(part["val"]).select(*KEYS, "series_enc", *C.SCALED_COLUMNS).toPandas()
    pd.testing.assert_frame_equal(got.set_index(KEYS).sort_index(), want.set_index(KEYS).sort_index(), check_dtype=False, rtol=1e-12)


def test_promoted_version_scores(spark, tables, fitted):
    retail, snap, _ = tables
    root = tempfile.mkdtemp(prefix="models-")
    for v in (1, 2):
        MS.save(spark, fitted[0], root, "tree", v)
    none = spark.createDataFrame([], "model string, version int, stage string, test_mae double")
    with pytest.raises(ValueError):
        MS.production_version(none, "tree")
    step = lambda old, v, mae: R.promote(old, spark.createDataFrame([("tree", v, mae)], "model string, version int, test_mae double"))
    versions = step(step(none, 1, 10.0), 2, 9.9)       # the second is not better by 5 %
    assert MS.production_version(versions, "tree") == 1
    lost = ("S001", "P0001")
    short = retail.filter(~((F.col("store_id") == lost[0]) & (F.col("product_id") == lost[1])))
    out = {(r["store_id"], r["product_id"]): r for r in QM.demand_from_store(spark, short, snap, root, versions).collect()}
    assert len(out) == snap.count() and {r["version"] for r in out.values()} == {1}
    last = {(r["store_id"], r["product_id"]): r["d"] for r in short.groupBy("store_id", "product_id").agg(F.max("date").alias("d")).collect()}
    assert out[lost]["cold_start"] and out[lost]["target_date"] == max(last.values()) + dt.timedelta(days=1)
    assert all(out[k]["target_date"] == d + dt.timedelta(days=1) and not out[k]["cold_start"] for k, d in last.items())


def test_patience_keeps_trees_after_a_rise():
    rise = [10 - 0.1 * i for i in range(20)] + [9.0 + 0.01 * i for i in range(10)] + [8 - 0.1 * i for i in range(5)]
    errors = rise + [9.0] * 40
    assert BO.best_round(errors) == (35, True)
    assert BO.best_round(errors, patience=8) == (20, True)
    assert BO.best_round(errors[:50]) == (35, False)          # too near the end: more rounds are needed


def test_cut_ensemble_is_the_best_prefix(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.normal(size=400), "b": rng.normal(size=400)})
    pdf["y"] = pdf["a"] * 3 + rng.normal(size=400) * 2
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame(pdf))
    train, val = df.limit(250), df.subtract(df.limit(250))
    gbt = GBTRegressor(labelCol="y", maxIter=64, maxDepth=4, stepSize=0.4, seed=7, predictionCol="p")
    model, errors = BO.fit_with_patience(gbt, train, val, patience=6, start=4)
    best = int(np.argmin(errors)) + 1
    assert model.getNumTrees == BO.best_round(errors, 6)[0] and best <= len(errors) <= 64 and len(errors) > 4
    got = model.transform(val).agg(F.avg(F.abs(F.col("p") - F.col("y")))).first()[0]
    assert abs(got - errors[model.getNumTrees - 1]) < 1e-9
    whole, _ = BO.fit_with_patience(gbt.copy({gbt.maxIter: 5}), train, val, patience=30)
    assert whole.getNumTrees <= 5


def test_missing_values_get_a_side(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=600)
    gone = rng.random(600) < 0.3
    y = np.where(gone, 20.0, 5 * x) + rng.normal(size=600) * 0.1
    rows = [(None if g else float(v), 1.0, float(t)) for v, g, t in zip(x, gone, y)]
    df = spark.createDataFrame(rows, "x double, full double, y double")
    stage, names = BO.missing_sides(df, ["x", "full"])
    assert names == ["x", "full", "x__missing"]
    model = GBTRegressor(labelCol="y", maxIter=30, maxDepth=3, stepSize=0.3, seed=1).fit(
        VectorAssembler(inputCols=names, outputCol="features").transform(stage.transform(df)))
    test = spark.createDataFrame([(None, None, 0.0), (0.0, 1.0, 0.0)], "x double, full double, y double")
    out = model.transform(VectorAssembler(inputCols=names, outputCol="features").transform(stage.transform(test))).collect()
    assert abs(out[0]["prediction"] - 20) < 1 and abs(out[1]["prediction"]) < 2


def brute_shapley(nodes, x, n_features):
    """All subsets: the expected prediction when only the features of a subset are known."""
    trees = {}
    for r in nodes:
        trees.setdefault(r["tree"], {})[r["node"]] = r

    def value(tree, at, known):
        r = tree[at]
        if r["left"] < 0:
            return r["prediction"] * r["weight"]
        if r["feature"] in known:
            return value(tree, r["left"] if x[r["feature"]] <= r["threshold"] else r["right"], known)
        return sum(value(tree, c, known) * tree[c]["cover"] for c in (r["left"], r["right"])) / r["cover"]
    total = lambda known: sum(value(t, 0, known) for t in trees.values())
    out = []
    for f in range(n_features):
        others = [g for g in range(n_features) if g != f]
        out.append(sum(math.factorial(k) * math.factorial(n_features - 1 - k) / math.factorial(n_features)
                       * (total({*s, f}) - total(set(s))) for k in range(n_features) for s in itertools.combinations(others, k)))
    return np.array(out), total(set())


def test_attribution_equals_all_subsets(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4))
    y = x[:, 0] * 2 + np.where(x[:, 1] > 0, x[:, 2], -1) + rng.normal(size=300) * 0.1
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))],
                               "id long, a double, b double, c double, d double, y double")
    asm = VectorAssembler(inputCols=list("abcd"), outputCol="features")
    gbt = GBTRegressor(labelCol="y", maxIter=6, maxDepth=3, stepSize=0.5, seed=2, predictionCol="raw_prediction").fit(asm.transform(df))
    nodes = BO.node_table(spark, gbt, os.path.join(tempfile.mkdtemp(prefix="nodes-"), "m")).collect()
    pipeline = PipelineModel([asm, gbt])
    got = AT.explain(pipeline, df.limit(40), ["id"]).toPandas().pivot(index="id", columns="feature", values="value")[list("abcd")]
    base = AT.explain(pipeline, df.limit(1), ["id"]).first()["base"]
    pred = {r["id"]: r["raw_prediction"] for r in pipeline.transform(df).collect()}
    for i, row in got.iterrows():
        want, mean = brute_shapley(nodes, x[i], 4)
        assert np.allclose(row.to_numpy(), want, atol=1e-9) and abs(base - mean) < 1e-9
        assert abs(row.sum() - (pred[i] - base)) < 1e-9


def test_attribution_of_the_stored_pipeline_adds_up(spark, fitted):
    pipeline, part = fitted
    sample = AT.attribution_sample(part["test"], KEYS, n=50)
    values = AT.explain(pipeline, sample, KEYS)
    sums = values.groupBy(*KEYS).agg(F.sum("value").alias("s"), F.first("base").alias("base"), F.count("*").alias("n"))
    scored = pipeline.transform(sample).select(*KEYS, "raw_prediction")
    rows = sums.join(scored, KEYS).collect()
    assert len(rows) == 50 and {r["n"] for r in rows} == {len(pipeline.stages[-2].getInputCols())}
    assert all(abs(r["s"] - (r["raw_prediction"] - r["base"])) < 1e-9 for r in rows)
    top = AT.mean_attribution(values).collect()
    assert len(top) == 20 and top[0]["mean_abs_value"] >= top[1]["mean_abs_value"] > 0
    again = AT.attribution_sample(part["test"].repartition(7), KEYS, n=50)
    assert sorted(again.select(*KEYS).collect()) == sorted(sample.select(*KEYS).collect())

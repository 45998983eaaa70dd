"""Forecasters, tuning and scoring (M05-M08, M12, M13, A13-A15 reuse).

* M05, re-aimed: the per-series seasonal model is a ridge regression per
  series on [trend, 25 trend hinges in the first 80% of the history, weekly
  (3) and yearly (10) Fourier terms, 9 regressors], fitted with
  ``groupBy(series).applyInPandas``: one group is one series (bounded by the
  calendar, not by data volume) and thousands of series fit in parallel.  It
  is not numerically the Stan MAP fit of the source; it is checked against
  the naive baseline instead.
* M06: ``pyspark.ml`` ``GBTRegressor`` with row weights, a validation
  indicator for early stopping, 0.8 row subsampling, depth 6, rate 0.05.
* M07: walk-forward evaluation loops over at most ``n_folds`` folds, each
  a distributed fit.
* M08, re-aimed: seeded random candidates as data; per-series candidates are
  an ``explode`` of the candidate list per row and one
  ``groupBy(series, trial).applyInPandas`` (no cross join).
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast import config as C
from shelfcast.operators.bias import regression_metrics
from shelfcast.operators.splits import apply_scaler, encode_series, fold_membership, scaler_stats
from shelfcast.session import cut_lineage

# Regressors of the per-series model (names of the v2 feature table).
SERIES_REGRESSORS = ["holiday_promotion", "discount", "price_vs_competitor", "effective_price",
                     "discount_x_holiday", "inventory_level", "stockout_flag", "lead_time_demand",
                     "demand_forecast_lag1"]

SERIES_DEFAULTS = {"ridge": 1.0, "n_changepoints": 25, "changepoint_range": 0.8,
                   "weekly_order": 3, "yearly_order": 10}

SERIES_OUT = ("store_id string, product_id string, as_of_date date, split string, y double, "
              "prediction double, n_train long")


def _design(t: np.ndarray, X: np.ndarray, cps: np.ndarray, wk: int, yr: int) -> np.ndarray:
    cols = [np.ones_like(t), t]
    cols += [np.maximum(0.0, t - c) for c in cps]
    for k in range(1, wk + 1):
        cols += [np.sin(2 * np.pi * k * t * 365.25 / 7.0), np.cos(2 * np.pi * k * t * 365.25 / 7.0)]
    for k in range(1, yr + 1):
        cols += [np.sin(2 * np.pi * k * t), np.cos(2 * np.pi * k * t)]
    return np.column_stack(cols + ([X] if X.size else []))


def _fit_predict(pdf: pd.DataFrame, params: dict, regressors: Sequence[str], min_rows: int) -> pd.DataFrame:
    pdf = pdf.sort_values("as_of_date")
    train = pdf["split"].values == "train"
    n_train = int(train.sum())
    out = pd.DataFrame({"store_id": pdf["store_id"].values, "product_id": pdf["product_id"].values,
                        "as_of_date": pdf["as_of_date"].values, "split": pdf["split"].values,
                        "y": pdf["y"].astype(float).values, "prediction": np.nan, "n_train": n_train})
    if n_train < min_rows:
        return out.iloc[0:0]
    d = pd.to_datetime(pdf["as_of_date"])
    t0 = d[train].min()
    t = ((d - t0).dt.days.values / 365.25).astype(float)
    X = pdf[list(regressors)].astype(float).fillna(0.0).values if regressors else np.empty((len(pdf), 0))
    mu, sd = X[train].mean(axis=0), X[train].std(axis=0)
    sd[sd == 0] = 1.0
    X = (X - mu) / sd
    t_train = t[train]
    span = t_train.max() * params["changepoint_range"]
    cps = np.linspace(0, span, int(params["n_changepoints"]) + 2)[1:-1] if span > 0 else np.array([])
    A = _design(t, X, cps, int(params["weekly_order"]), int(params["yearly_order"]))
    y = np.clip(pdf["y"].astype(float).values, 0, None)
    At, yt = A[train], y[train]
    lam = float(params["ridge"]) * np.eye(A.shape[1])
    lam[0, 0] = 0.0
    coef = np.linalg.solve(At.T @ At + lam, At.T @ yt)
    out["prediction"] = np.clip(A @ coef, 0, None)
    return out


def fit_predict_series(df: DataFrame, params: dict | None = None,
                       regressors: Sequence[str] = SERIES_REGRESSORS,
                       min_rows: int = C.MIN_SERIES_HISTORY) -> DataFrame:
    """Per-series fit on ``split == 'train'`` rows, predictions for every row.

    Series with fewer than ``min_rows`` train rows are skipped (P11).
    """
    p = dict(SERIES_DEFAULTS, **(params or {}))
    regs = [r for r in regressors if r in df.columns]
    cols = ["store_id", "product_id", "as_of_date", "split", "y", *regs]
    data = df.select(*cols)
    return data.groupBy("store_id", "product_id").applyInPandas(
        lambda pdf: _fit_predict(pdf, p, regs, min_rows), SERIES_OUT)


def random_candidates(n: int, space: dict[str, tuple[float, float]], seed: int = 42,
                      log_scale: Sequence[str] = ()) -> list[dict]:
    """Seeded random search candidates (the trial list itself is tiny, n entries)."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        c = {}
        for k, (lo, hi) in space.items():
            if k in log_scale:
                c[k] = float(np.exp(rng.uniform(np.log(lo), np.log(hi))))
            else:
                c[k] = float(rng.uniform(lo, hi))
        out.append({"trial": i, **c})
    return out


SERIES_SPACE = {"ridge": (0.01, 100.0), "changepoint_range": (0.6, 0.95), "n_changepoints": (5, 30)}


def tune_series(df: DataFrame, n_trials: int = 20, seed: int = 42,
                regressors: Sequence[str] = SERIES_REGRESSORS,
                min_rows: int = C.MIN_SERIES_HISTORY) -> DataFrame:
    """M08 (per-series part): every candidate fitted on every series, scored by val MAE.

    Rows are replicated per candidate with ``explode`` of the literal
    candidate array (n_trials copies, bounded by the budget) and fitted by
    one ``groupBy(series, trial).applyInPandas``; output is the trials
    table ``(model, trial, state, mae, params)``.
    """
    cands = random_candidates(n_trials, SERIES_SPACE, seed, log_scale=("ridge",))
    regs = [r for r in regressors if r in df.columns]
    arr = F.array(*[F.struct(F.lit(c["trial"]).alias("trial"), F.lit(c["ridge"]).alias("ridge"),
                             F.lit(c["changepoint_range"]).alias("changepoint_range"),
                             F.lit(float(int(c["n_changepoints"]))).alias("n_changepoints")) for c in cands])
    data = df.select("store_id", "product_id", "as_of_date", "split", "y", *regs,
                     F.explode(arr).alias("c")).select("*", "c.*").drop("c")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        p = dict(SERIES_DEFAULTS, ridge=pdf["ridge"].iloc[0], changepoint_range=pdf["changepoint_range"].iloc[0],
                 n_changepoints=pdf["n_changepoints"].iloc[0])
        r = _fit_predict(pdf, p, regs, min_rows)
        v = r[r["split"] == "val"]
        err = float(np.abs(v["y"] - v["prediction"]).sum()) if len(v) else 0.0
        return pd.DataFrame({"trial": [int(pdf["trial"].iloc[0])], "abs_err": [err], "n": [len(v)],
                             "ridge": [p["ridge"]], "changepoint_range": [p["changepoint_range"]],
                             "n_changepoints": [float(p["n_changepoints"])]})

    per = data.groupBy("store_id", "product_id", "trial").applyInPandas(
        run, "trial long, abs_err double, n long, ridge double, changepoint_range double, n_changepoints double")
    t = per.groupBy("trial").agg(F.sum("abs_err").alias("e"), F.sum("n").alias("n"),
                                 F.first("ridge").alias("ridge"), F.first("changepoint_range").alias("cr"),
                                 F.first("n_changepoints").alias("nc"))
    return t.select(F.lit("seasonal").alias("model"), "trial",
                    F.when(F.col("n") > 0, "COMPLETE").otherwise("FAIL").alias("state"),
                    (F.col("e") / F.col("n")).alias("mae"),
                    F.create_map(F.lit("ridge"), F.col("ridge"), F.lit("changepoint_range"), F.col("cr"),
                                 F.lit("n_changepoints"), F.col("nc")).alias("params"))


# Row share, column share (per split here), node size and depth as the source sets them.
# Early stopping differs: the source waits 30 rounds for a better error, Spark ends at the
# first round that gains less than ``validationTol`` (relative).
GBT_DEFAULTS = {"maxDepth": 6, "stepSize": 0.05, "maxIter": 500, "subsamplingRate": 0.8,
                "featureSubsetStrategy": "0.8", "minInstancesPerNode": 5, "validationTol": 0.001, "seed": 42}


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def _trees(params: dict | None, weight: str | None, validation: str | None) -> GBTRegressor:
    p = dict(GBT_DEFAULTS, **(params or {}))
    gbt = GBTRegressor(featuresCol="features", labelCol="y", predictionCol="raw_prediction", lossType="squared",
                       **{k: v for k, v in p.items()})
    if weight:
        gbt.setWeightCol(weight)
    if validation:
        gbt.setValidationIndicatorCol(validation)
    return gbt


def gbt_pipeline(features: Sequence[str], params: dict | None = None, weight: str | None = "sample_weight",
                 validation: str | None = "is_val") -> Pipeline:
    """Assembler + boosted trees (squared error, row weights, early stopping)."""
    return Pipeline(stages=[_assembler(features), _trees(params, weight, validation)])


def _prepare(df: DataFrame, features: Sequence[str]) -> DataFrame:
    # The tree library of the source treats missing values natively; Spark's
    # trees need numbers: missing features become 0.
    df = df.fillna(0, subset=list(features))
    return df.withColumn("y", F.col("y").cast("double")) if "y" in df.columns else df  # rows to score have no label


def fit_gbt(train: DataFrame, val: DataFrame | None, features: Sequence[str], params: dict | None = None,
            weight: str | None = "sample_weight") -> PipelineModel:
    """M06 fit: validation rows (if any) drive early stopping, they are not fitted."""
    feats = [f for f in features if f in train.columns]
    tr = _prepare(train, feats).withColumn("is_val", F.lit(False))
    if val is not None:
        tr = tr.unionByName(_prepare(val, feats).withColumn("is_val", F.lit(True)), allowMissingColumns=True)
    w = weight if weight and weight in train.columns else None
    return gbt_pipeline(feats, params, w, "is_val" if val is not None else None).fit(tr)


def predict(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Batch scoring with the fitted pipeline; predictions floored at 0."""
    feats = [f for f in features if f in df.columns]
    out = model.transform(_prepare(df, feats))
    return (out.withColumn("prediction", F.greatest(F.col("raw_prediction"), F.lit(0.0)))
               .withColumn("predicted_demand", predicted_demand("prediction"))
               .drop("features", "raw_prediction"))


def feature_importance(model: PipelineModel, features: Sequence[str], top: int = 10) -> DataFrame:
    """The tree model's gain importances, top ``top``."""
    spark = SparkSession.getActiveSession()
    imp = model.stages[-1].featureImportances.toArray().tolist()
    feats = list(model.stages[0].getInputCols())
    rows = sorted(zip(feats, imp), key=lambda r: (-r[1], r[0]))[:top]
    return spark.createDataFrame(rows, "feature string, importance double")


def fold_inputs(train: DataFrame, n_folds: int = C.N_FOLDS, gap_days: int = C.FOLD_GAP_DAYS,
                val_days: int = C.FOLD_VAL_DAYS) -> list[tuple[int, DataFrame]]:
    """M07 inputs: per fold the member rows with ``role``, encoded and scaled by the fold's training rows only.

    A series unseen in the fold's training rows gets code -1.  Each fold is
    written once to the shared folder, so every trial and fit reads the same table.
    """
    m = cut_lineage(fold_membership(train, n_splits=n_folds, gap_days=gap_days, val_days=val_days))
    out = []
    for f in sorted(r["fold_number"] for r in m.select("fold_number").distinct().collect()):
        rows = m.filter(F.col("fold_number") == f)
        fit_on = rows.filter(F.col("role") == "train")
        if "series_id" in rows.columns:
            _mapping, _train, rows = encode_series(fit_on, rows)
        if any(c in rows.columns for c in C.SCALED_COLUMNS):
            rows = apply_scaler(rows, scaler_stats(fit_on))
        out.append((f, cut_lineage(rows)))
    return out


def fold_vectors(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """What a fit needs of a fold from :func:`fold_inputs`: ``y``, ``features`` (vector), ``is_val`` and the weight."""
    feats = [f for f in features if f in rows.columns]
    keep = ["y", "features", "is_val", *(c for c in ("sample_weight",) if c in rows.columns)]
    return _assembler(feats).transform(_prepare(rows, feats)).withColumn("is_val", F.col("role") == "val").select(*keep)


def walk_forward_eval(train: DataFrame, features: Sequence[str], params: dict | None = None,
                      n_folds: int = C.N_FOLDS, folds: list[tuple[int, DataFrame]] | None = None) -> DataFrame:
    """Per fold fit on the fold's train rows (its val rows stop early), MAE/RMSE/R2 on val.

    ``train`` holds raw features; ``folds`` (from :func:`fold_inputs`, or their :func:`fold_vectors`) saves preparing
    them again.
    """
    metrics = []
    for f, rows in folds if folds is not None else fold_inputs(train, n_folds):  # n_folds distributed fits
        vectors = rows if "features" in rows.columns else fold_vectors(rows, features)
        weight = "sample_weight" if "sample_weight" in vectors.columns else None
        scored = _trees(params, weight, "is_val").fit(vectors).transform(vectors.filter("is_val"))
        scored = scored.withColumn("prediction", F.greatest(F.col("raw_prediction"), F.lit(0.0)))
        metrics.append((f, regression_metrics(scored, pred="prediction").first()))
    return train.sparkSession.createDataFrame(
        [(f, r["mae"], r["rmse"], r["mape"], r["r2"], r["n"]) for f, r in metrics],
        "fold_number int, mae double, rmse double, mape double, r2 double, n long")


def feature_matrix(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The available feature columns (absent ones are skipped); leftover string
    columns become integer codes by their sorted distinct values (distributed
    dense index per column, broadcast under a checked bound)."""
    from shelfcast.functions.joins import bounded_broadcast
    from shelfcast.operators.splits import dense_index
    avail = [f for f in features if f in df.columns]
    out = df.select(*keep, *[f for f in avail if f not in keep])
    for f in avail:
        if dict(out.dtypes)[f] == "string":
            codes = bounded_broadcast(dense_index(out, f, "__code"))
            out = out.join(codes, f, "left").withColumn(f, F.col("__code")).drop("__code")
    return out


def predicted_demand(pred) -> "F.Column":
    """reported prediction: max(0, y_hat) rounded half-even to 2."""
    from shelfcast.functions.scalar import round_half_even
    return round_half_even(F.greatest(F.col(pred) if isinstance(pred, str) else pred, F.lit(0.0)), 2)


def permutation_importance(model: PipelineModel, df: DataFrame, features: Sequence[str],
                           seed: int = 42, n_buckets: int = 64, top: int = 20,
                           keys: Sequence[str] = ("store_id", "product_id", "as_of_date")) -> DataFrame:
    """M12 (re-aimed): MAE increase when one feature's values are permuted.

    A permutation without global row numbers: rows are spread over hash
    buckets of their keys (``n_buckets``, a parameter: no setting changes the result); inside a bucket, rows in a seeded random order take
    the value of the previous row (the first takes the last): a cyclic shift,
    i.e. a random permutation per bucket.  All features are scored in one
    pass: the frame is exploded once per feature (bounded by the feature
    count), the swapped column is chosen per copy, and one ``transform`` plus
    one grouped MAE gives every delta.
    """
    from pyspark.sql import Window
    feats = [f for f in features if f in df.columns]
    kc = [F.col(k) for k in keys if k in df.columns]
    base = _prepare(df, feats).withColumns({
        "__b": F.pmod(F.xxhash64(F.lit(seed), *kc), F.lit(n_buckets)),
        "__r": F.xxhash64(F.lit(seed + 1), *kc)})
    w = Window.partitionBy("__b").orderBy("__r")
    wall = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    perm = {f"__p_{i}": F.coalesce(F.lag(f, 1).over(w), F.last(f).over(wall)) for i, f in enumerate(feats)}
    p = base.withColumns(perm)
    variants = F.explode(F.sequence(F.lit(-1), F.lit(len(feats) - 1))).alias("__v")
    x = p.select("*", variants)
    x = x.withColumns({f: F.when(F.col("__v") == i, F.col(f"__p_{i}")).otherwise(F.col(f))
                       for i, f in enumerate(feats)})
    scored = model.transform(x.drop(*perm.keys()))
    err = F.abs(F.greatest(F.col("raw_prediction"), F.lit(0.0)) - F.col("y"))
    mae = scored.groupBy("__v").agg(F.avg(err).alias("mae"))
    names = F.array(*[F.lit(f) for f in feats])
    baseline = mae.filter(F.col("__v") == -1).select(F.col("mae").alias("__base"))
    from shelfcast.functions.joins import attach_row
    out = attach_row(mae.filter(F.col("__v") >= 0), baseline)
    res = out.select(F.element_at(names, (F.col("__v") + 1).cast("int")).alias("feature"),
                     (F.col("mae") - F.col("__base")).alias("mae_increase"))
    return res.orderBy(F.col("mae_increase").desc(), "feature").limit(top)


# FIXED VALUES: ranges of the source's search (L1 and L2 penalties have no counterpart in Spark's trees).
GBT_SPACE = {"maxDepth": (3, 10), "stepSize": (0.01, 0.3), "maxIter": (100, 800), "subsamplingRate": (0.5, 1.0),
             "featureSubsetStrategy": (0.4, 1.0), "minInstancesPerNode": (1, 20), "minInfoGain": (0.0, 5.0)}
WHOLE = ("maxDepth", "maxIter", "minInstancesPerNode")


def tune_gbt(train: DataFrame, features: Sequence[str], n_trials: int = 50, seed: int = 42,
             n_folds: int = C.N_FOLDS, space: dict | None = None, threads: int = 4) -> DataFrame:
    """M08 (tree part, re-aimed): seeded random search scored by mean walk-forward MAE.

    At most ``n_trials`` x ``n_folds`` distributed fits (the budget is the
    bound); the folds are prepared once, their vectors are kept by the executors
    (on disk where memory is short) for the time of the search, and ``threads``
    trials run at a time, so small fits share the cluster.  The trials table
    ``(model, trial, state, mae, params)`` feeds ``param_sensitivity`` and ``top_trials``.
    """
    spark = train.sparkSession
    folds = [(f, fold_vectors(rows, features).persist(StorageLevel.MEMORY_AND_DISK)) for f, rows in fold_inputs(train, n_folds)]

    def trial(c: dict) -> tuple:
        params = {k: int(c[k]) if k in WHOLE else c[k] for k in (space or GBT_SPACE)}
        used = {k: str(v) if k == "featureSubsetStrategy" else v for k, v in params.items()}
        mae = walk_forward_eval(train, features, used, folds=folds).agg(F.avg("mae")).first()[0]
        return ("gbt", c["trial"], "COMPLETE" if mae is not None else "FAIL", mae, {k: float(v) for k, v in params.items()})
    try:
        with ThreadPoolExecutor(max_workers=threads) as pool:
            rows = list(pool.map(trial, random_candidates(n_trials, space or GBT_SPACE, seed, log_scale=("stepSize",))))
    finally:
        for _, vectors in folds:
            vectors.unpersist()
    return spark.createDataFrame(rows, "model string, trial long, state string, mae double, "
                                       "params map<string,double>")

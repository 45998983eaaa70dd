"""Queries: forecasters, tuning, registry decisions, intent routing.

Model fits are not SQL-expressible: those keys have no oracle (rows-only
check).  The registry decisions run over a metrics table that SQL can
compute too — the test-split metrics of three deterministic predictors
(naive lag-1 baseline, 7-row rolling mean, EWM-28) — so they do have one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from shelfcast import config as C
from shelfcast.functions import scalar as S
from shelfcast.functions.joins import attach_row
from shelfcast.operators import attribution as AT
from shelfcast.operators import bias as B
from shelfcast.operators import features as FE
from shelfcast.operators import forecast as FC
from shelfcast.operators import intent as IN
from shelfcast.operators import model_store as MS
from shelfcast.operators import registry as R
from shelfcast.operators import scoring as SC
from shelfcast.operators import seasonal as SE
from shelfcast.operators import splits as SP
from shelfcast.operators import tuning as TU
from shelfcast.plans import tables as TB
from shelfcast.plans.catalog import register
from shelfcast.session import cut_lineage, scratch_path
from shelfcast.plans.q_splits import split_df, split_table, ssql

PREDICTORS = [("naive_lag1", "y_pred_baseline"), ("rolling_mean_7", "sales_roll_mean_7"),
              ("ewm_28", "sales_ewm_28")]


def metrics_df(spark, sf_dir):
    """The metrics control table (a few rows), materialised once: the registry
    decisions read it several times."""
    sp = split_df(spark, sf_dir).filter(F.col("split").isin("val", "test"))
    long = sp.select("split", "y", F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("prediction")) for m, c in PREDICTORS]))
        .alias("p")).select("split", "y", "p.*")
    return cut_lineage(B.regression_metrics(long, pred="prediction", group=["model", "split"]))


def _metrics_sql() -> str:
    e = "(CAST(y AS DOUBLE) - prediction)"
    pred = " UNION ALL ".join(f"SELECT split, y, '{m}' AS model, CAST({c} AS DOUBLE) AS prediction FROM sp "
                              f"WHERE split IN ('val', 'test')" for m, c in PREDICTORS)
    return f"""SELECT model, split, round_even(avg(abs({e})), 4) AS mae, round_even(sqrt(avg({e} * {e})), 4) AS rmse,
  round_even(avg(CASE WHEN y > 0 THEN abs({e} / y) END) * 100e0, 4) AS mape,
  round_even(CASE WHEN var_pop(CAST(y AS DOUBLE)) * COUNT(y) > 0
             THEN 1e0 - SUM({e} * {e}) / (var_pop(CAST(y AS DOUBLE)) * COUNT(y)) END, 4) AS r2,
  COUNT(*) AS n FROM ({pred}) p GROUP BY model, split"""


MET = [("met", _metrics_sql())]


@register("prediction_metrics", ssql("SELECT * FROM met", MET))
def q_prediction_metrics(spark, sf_dir):
    return metrics_df(spark, sf_dir)


PREF = [m for m, _ in PREDICTORS]


@register("model_selection", ssql(f"""SELECT w.model AS winner, w.mae AS winner_mae, r.model AS runner_up,
  r.mae AS runner_up_mae, CASE WHEN r.mae > 0 THEN (r.mae - w.mae) / r.mae * 100e0 END AS improvement_percent
FROM (SELECT model, mae, row_number() OVER (ORDER BY mae, p) AS k FROM
        (SELECT model, mae, CASE model {" ".join(f"WHEN '{m}' THEN {i + 1}" for i, m in enumerate(PREF))}
                ELSE {len(PREF) + 1} END AS p FROM met WHERE split = 'test' AND mae IS NOT NULL) a) w
LEFT JOIN (SELECT model, mae, row_number() OVER (ORDER BY mae, p) AS k FROM
        (SELECT model, mae, CASE model {" ".join(f"WHEN '{m}' THEN {i + 1}" for i, m in enumerate(PREF))}
                ELSE {len(PREF) + 1} END AS p FROM met WHERE split = 'test' AND mae IS NOT NULL) b) r ON r.k = 2
WHERE w.k = 1""", MET))
def q_model_selection(spark, sf_dir):
    return R.select_model(metrics_df(spark, sf_dir), PREF)


@register("model_comparison", ssql("""SELECT metric,
  """ + ", ".join(f"max(CASE WHEN model = '{m}' THEN value END) AS {m}" for m in sorted(PREF)) + """
FROM (SELECT model, 'mae' AS metric, mae AS value FROM met WHERE split = 'test'
      UNION ALL SELECT model, 'rmse', rmse FROM met WHERE split = 'test'
      UNION ALL SELECT model, 'r2', r2 FROM met WHERE split = 'test') l GROUP BY metric""", MET))
def q_model_comparison(spark, sf_dir):
    return R.model_comparison(metrics_df(spark, sf_dir))


def versions_df(spark, sf_dir):
    """Registry fixture derived from the data: version 1 of each predictor is in
    Production with its validation MAE; version 2 (the candidate) carries the test MAE."""
    m = metrics_df(spark, sf_dir)
    v1 = m.filter(F.col("split") == "val").select("model", F.lit(1).alias("version"),
                                                   F.lit("Production").alias("stage"), F.col("mae").alias("test_mae"))
    v2 = m.filter(F.col("split") == "test").select("model", F.lit(2).alias("version"),
                                                    F.lit("None").alias("stage"), F.col("mae").alias("test_mae"))
    return v1, v2


PROMO = """SELECT model, version, CASE WHEN stage = 'Production' AND promote THEN 'Archived' ELSE stage END AS stage,
  test_mae FROM v1 JOIN dec USING (model)
UNION ALL SELECT model, 2, CASE WHEN promote THEN 'Production' ELSE 'Archived' END, new_mae FROM dec"""
DEC = """SELECT v2.model, v2.test_mae AS new_mae, v1.test_mae AS cur_mae,
  COALESCE(v1.version IS NULL OR v1.test_mae IS NULL OR (v1.test_mae - v2.test_mae) / v1.test_mae >= 0.05, false)
    AS promote
FROM (SELECT model, mae AS test_mae FROM met WHERE split = 'test') v2
LEFT JOIN (SELECT model, 1 AS version, mae AS test_mae FROM met WHERE split = 'val') v1 USING (model)"""
V1 = "SELECT model, 1 AS version, 'Production' AS stage, mae AS test_mae FROM met WHERE split = 'val'"


@register("promotion_gate", ssql("SELECT * FROM promo", MET + [("v1", V1), ("dec", DEC), ("promo", PROMO)]))
def q_promotion_gate(spark, sf_dir):
    v1, v2 = versions_df(spark, sf_dir)
    return R.promote(v1, v2.drop("stage").withColumn("stage", F.lit("None")))


@register("rollback_target", ssql("""SELECT model, version,
  CASE WHEN rb AND version = cur THEN 'Archived' WHEN rb AND version = tgt THEN 'Production' ELSE stage END AS stage,
  test_mae, COALESCE(rb, false) AS rolled_back
FROM promo LEFT JOIN (SELECT 'naive_lag1' AS model, cur, tgt, COALESCE(cur IS NOT NULL AND tgt IS NOT NULL
     AND cur <> tgt, false) AS rb
  FROM (SELECT max(CASE WHEN stage = 'Production' THEN version END) AS cur,
               max(CASE WHEN stage = 'Archived' THEN version END) AS tgt FROM promo WHERE model = 'naive_lag1') x) r
  USING (model)""", MET + [("v1", V1), ("dec", DEC), ("promo", PROMO)]))
def q_rollback_target(spark, sf_dir):
    v1, v2 = versions_df(spark, sf_dir)
    promoted = R.promote(v1, v2.drop("stage").withColumn("stage", F.lit("None")))
    return R.rollback(promoted, "naive_lag1")


WINDOWS = [3, 7, 14, 28]


def window_trials_df(spark, sf_dir):
    """M08 on a model family SQL can score: the k-row rolling-mean predictor, k in WINDOWS,
    scored by validation MAE (trial table with params map)."""
    from pyspark.sql import Window
    f = split_df(spark, sf_dir)
    w = Window.partitionBy("store_id", "product_id").orderBy("as_of_date")
    cols = {f"_m{k}": F.avg("sales_lag_1").over(w.rowsBetween(-(k - 1), 0)) for k in WINDOWS}
    v = f.withColumns(cols).filter(F.col("split") == "val")
    long = v.select("y", F.explode(F.array(*[F.struct(F.lit(i).alias("trial"), F.lit(float(k)).alias("k"),
                                                      F.col(f"_m{k}").alias("pred"))
                                             for i, k in enumerate(WINDOWS)])).alias("t")).select("y", "t.*")
    g = long.groupBy("trial", "k").agg(F.avg(F.abs(F.col("y") - F.col("pred"))).alias("mae"))
    return g.select(F.lit("rolling_mean").alias("model"), "trial", F.lit("COMPLETE").alias("state"), "mae",
                    F.create_map(F.lit("window"), F.col("k")).alias("params"))


def _window_trials_sql() -> str:
    cols = ", ".join(f"avg(sales_lag_1) OVER (PARTITION BY store_id, product_id ORDER BY as_of_date "
                     f"ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) AS m{k}" for k in WINDOWS)
    parts = " UNION ALL ".join(f"SELECT {i} AS trial, {k}e0 AS k, y, m{k} AS pred FROM v"
                               for i, k in enumerate(WINDOWS))
    return (f"SELECT * FROM (SELECT *, {cols} FROM sp) z WHERE split = 'val'",
            f"SELECT trial, k, avg(abs(y - pred)) AS mae FROM ({parts}) t GROUP BY trial, k")


_V, _T = _window_trials_sql()


@register("window_search", ssql("SELECT 'rolling_mean' AS model, trial, 'COMPLETE' AS state, mae, k AS window FROM t",
                                [("v", _V), ("t", _T)]))
def q_window_search(spark, sf_dir):
    t = window_trials_df(spark, sf_dir)
    return t.select("model", "trial", "state", "mae", F.col("params")["window"].alias("window"))


@register("param_sensitivity", ssql("""SELECT 'rolling_mean' AS model, 'window' AS param,
  corr(k, mae) AS corr_with_mae, COUNT(*) AS n_trials FROM t""", [("v", _V), ("t", _T)]))
def q_param_sensitivity(spark, sf_dir):
    return R.param_sensitivity(window_trials_df(spark, sf_dir))


@register("top_trials", ssql("""SELECT 'rolling_mean' AS model, trial, 'COMPLETE' AS state, mae,
  CAST(row_number() OVER (ORDER BY mae, trial) AS INTEGER) AS rank FROM t QUALIFY rank <= 5""",
                             [("v", _V), ("t", _T)]))
def q_top_trials(spark, sf_dir):
    return R.top_trials(window_trials_df(spark, sf_dir)).select("model", "trial", "state", "mae", "rank")


# --- model fits (rows-only checks) ---------------------------------------------------

@register("seasonal_forecast")
def q_seasonal_forecast(spark, sf_dir):
    """Per-series multiplicative model, predictions on every row of every series."""
    return SE.forecast(cut_lineage(split_df(spark, sf_dir)))


@register("seasonal_metrics")
def q_seasonal_metrics(spark, sf_dir):
    """A14 on M05: val/test metrics per split, pooled over series."""
    p = SE.forecast(cut_lineage(split_df(spark, sf_dir))).filter(F.col("split").isin("val", "test"))
    return B.regression_metrics(p, pred="prediction", group=["split"])


@register("seasonal_tuning")
def q_seasonal_tuning(spark, sf_dir):
    """M08 (per-series): 20 seeded candidates fitted on every series."""
    return FC.tune_series(split_df(spark, sf_dir), n_trials=20)


@register("seasonal_search")
def q_seasonal_search(spark, sf_dir):
    """M08 (per-series): 50 adaptive trials, halved over the walk-forward folds, both seasonality modes."""
    train = cut_lineage(split_df(spark, sf_dir).filter(F.col("split") == "train"))
    return TU.search_seasonal(train, scratch_path(spark, f"search-{uuid.uuid4().hex}"))


@register("seasonal_coefficients")
def q_seasonal_coefficients(spark, sf_dir):
    """The stored form of the model, one row of coefficients per series."""
    return SE.fit_series(split_df(spark, sf_dir).filter(F.col("split") == "train"))


def _gbt_inputs(spark, sf_dir):
    sp = split_table(spark, sf_dir)
    train = sp.filter(F.col("split") == "train")
    _mapping, _train, sp_enc = SP.encode_series(train, sp)
    stats = SP.scaler_stats(sp_enc.filter(F.col("split") == "train"))
    # the model inputs are read by several fits: materialise them once
    return cut_lineage(SP.apply_scaler(sp_enc, stats))


@register("gbt_forecast")
def q_gbt_forecast(spark, sf_dir):
    """M06 + M13: boosted trees fitted on train (val chooses the number of rounds, with patience), batch-scored on test."""
    sp = cut_lineage(split_table(spark, sf_dir))
    pipeline = MS.fit_pipeline(sp.filter(F.col("split") == "train"), sp.filter(F.col("split") == "val"))
    return MS.score(pipeline, sp.filter(F.col("split") == "test")).select("as_of_date", "store_id", "product_id", "y", "prediction")


@register("gbt_importance")
def q_gbt_importance(spark, sf_dir):
    """Top-10 gain importances of the fitted tree model."""
    d = _gbt_inputs(spark, sf_dir)
    model = FC.fit_gbt(d.filter(F.col("split") == "train"), d.filter(F.col("split") == "val"), C.TRAIN_FEATURES)
    return FC.feature_importance(model, C.TRAIN_FEATURES)


@register("intent_routing")
def q_intent_routing(spark, sf_dir):
    """Route every user question of the conversation table."""
    model = IN.train_router(spark)
    q = TB.turns(spark, sf_dir).filter(F.col("role") == "user").select("user_id", "convo_id", "turn", "text")
    return IN.route(model, q)


@register("gbt_permutation_importance")
def q_gbt_permutation_importance(spark, sf_dir):
    """M12 (re-aimed attribution): MAE increase per permuted feature on the test rows."""
    d = _gbt_inputs(spark, sf_dir)
    model = FC.fit_gbt(d.filter(F.col("split") == "train"), d.filter(F.col("split") == "val"), C.TRAIN_FEATURES)
    return FC.permutation_importance(model, d.filter(F.col("split") == "test"), C.TRAIN_FEATURES)


@register("walk_forward_eval")
def q_walk_forward_eval(spark, sf_dir):
    """M07 + A15: per-fold tree-model metrics; each fold is encoded and scaled by its own training rows."""
    train = split_table(spark, sf_dir).filter(F.col("split") == "train")
    per_fold = FC.walk_forward_eval(train, C.TRAIN_FEATURES)
    return per_fold.unionByName(SP.fold_average(per_fold, ["mae", "rmse", "r2"]).select(
        F.lit(-1).alias("fold_number"), F.col("avg_mae").alias("mae"), F.col("avg_rmse").alias("rmse"),
        F.lit(None).cast("double").alias("mape"), F.col("avg_r2").alias("r2"), F.col("n_folds").alias("n")))


@register("gbt_tuning")
def q_gbt_tuning(spark, sf_dir):
    """M08 (trees): the whole search, 50 trials on all walk-forward folds over the source's ranges."""
    train = split_table(spark, sf_dir).filter(F.col("split") == "train")
    return FC.tune_gbt(train, C.TRAIN_FEATURES)


def demand_from_store(spark, retail, snapshot, root, versions):
    """Next demand of every series with a snapshot row, by the promoted tree model as it is stored.

    A series without history gets the cold-start features (M15) as of the newest day.
    """
    stored = MS.load_production(spark, root, versions, "tree")
    horizon, maps = stored.meta["horizon"], stored.meta["code_maps"]
    rows = FE.features_v2(retail, snapshot, horizon=horizon, include_created_at=False, rows="latest", **maps)
    known = rows.join(snapshot.select("store_id", "product_id"), ["store_id", "product_id"], "left_semi")
    cold = SC.cold_start_features(snapshot.join(retail.select("store_id", "product_id").distinct(), ["store_id", "product_id"], "left_anti"))
    cold = attach_row(cold, retail.agg(F.max("date").alias("as_of_date"))).withColumns({
        "dow": S.weekday_monday0("as_of_date"), "month": F.month("as_of_date"),
        "series_id": F.concat_ws("_", "store_id", "product_id")})
    cold = cold.withColumn("is_weekend", (F.col("dow") >= 5).cast("int"))
    both = known.withColumn("cold_start", F.lit(False)).unionByName(cold.withColumn("cold_start", F.lit(True)), allowMissingColumns=True)
    return MS.score(stored.pipeline, both).select(
        "store_id", "product_id", F.date_add("as_of_date", horizon).alias("target_date"), "predicted_demand", "cold_start",
        F.lit(stored.meta["version"]).alias("version"))


@register("predicted_demand")
def q_predicted_demand(spark, sf_dir):
    """M06 -> M10 -> M13 -> F30: a model is fitted, stored and promoted; the next day's demand comes from what is stored."""
    retail, snap = TB.retail(spark, sf_dir), TB.snapshot(spark, sf_dir)
    sp = cut_lineage(split_table(spark, sf_dir))
    root = scratch_path(spark, f"models-{uuid.uuid4().hex}")
    part = {s: sp.filter(F.col("split") == s) for s in ("train", "val", "test")}
    pipeline = MS.fit_pipeline(part["train"], part["val"])
    MS.save(spark, pipeline, root, "tree", 1)
    mae = B.regression_metrics(MS.score(pipeline, part["test"]), pred="prediction").select(
        F.lit("tree").alias("model"), F.lit(1).alias("version"), F.col("mae").alias("test_mae"))
    none = spark.createDataFrame([], "model string, version int, stage string, test_mae double")
    return demand_from_store(spark, retail, snap, root, R.promote(none, mae))


@register("tree_attribution")
def q_tree_attribution(spark, sf_dir):
    """Top 20 features by mean absolute attribution over 500 test rows (the source's sample)."""
    sp = cut_lineage(split_table(spark, sf_dir))
    pipeline = MS.fit_pipeline(sp.filter(F.col("split") == "train"), sp.filter(F.col("split") == "val"))
    keys = ["store_id", "product_id", "as_of_date"]
    sample = AT.attribution_sample(sp.filter(F.col("split") == "test"), keys)
    return AT.mean_attribution(AT.explain(pipeline, sample, keys))

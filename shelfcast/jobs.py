"""End-to-end runs of the two batch lifecycles.

Plain sequential functions over the operators — no scheduler: each step is
a Spark job, outputs go to parquet/JSON under ``out_dir`` with the layouts of
``sources.writers``.  The feature table is written once and re-read by every
report (the "write once and re-read" plan), so the reports never recompute
the windows.
"""

from __future__ import annotations

import os

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast import config as C
from shelfcast.operators import attribution as AT
from shelfcast.operators import bias as B
from shelfcast.operators import features as FE
from shelfcast.operators import forecast as FC
from shelfcast.operators import model_store as MS
from shelfcast.operators import quality as Q
from shelfcast.operators import registry as R
from shelfcast.operators import seasonal as SE
from shelfcast.operators import splits as SP
from shelfcast.operators import tuning as TU
from shelfcast.session import released
from shelfcast.sources import readers as RD
from shelfcast.sources import writers as WR


def daily_features_job(spark: SparkSession, retail: DataFrame, snapshot: DataFrame, out_dir: str,
                       run_id: str, horizon: int = 1, max_anomalies: int = 0,
                       fail_on_anomalies: bool = False, order_col: str | None = None, table: str | None = None,
                       buckets: int = 64) -> dict:
    """Extract (change-checked copy) -> features -> statistics and checks ->
    anomalies (+ gate) -> bias.  Returns the one-row anomaly summary.

    ``order_col`` (the readers' ``_ingest``; taken by itself if ``retail`` has it) decides
    between conflicting rows of one day: the first ingested one counts (P02).  ``table`` names a
    catalog table that keeps the features bucketed by series, in place of store folders.  Statistics, missingness
    and value rules are observed by the write; the other reports read what is stored.
    """
    with released(spark):
        return _daily_features(spark, retail, snapshot, out_dir, run_id, horizon, max_anomalies, fail_on_anomalies,
                               order_col or (RD.INGEST if RD.INGEST in retail.columns else None), table, buckets)


def _daily_features(spark, retail, snapshot, out_dir, run_id, horizon, max_anomalies, fail_on_anomalies, order_col, table, buckets) -> dict:
    raw, changed = RD.extract_if_changed(retail, os.path.join(out_dir, "raw"), run_id)
    feats_path = os.path.join(out_dir, "features")
    seen = Q.Observed()
    made = seen.watch(FE.features_v2(raw, snapshot, horizon=horizon, order_col=order_col))
    if table:
        WR.write_bucketed(made, table, feats_path, buckets)
        f = spark.table(table)
    else:
        WR.write_features(made, feats_path)
        f = spark.read.parquet(feats_path)
    rep = os.path.join(out_dir, "reports")
    WR.write_report(spark.createDataFrame(Q.schema_dump(f), "column string, type string"),
                    os.path.join(rep, "schema"))
    WR.write_report(seen.column_stats(), os.path.join(rep, "stats"))
    WR.write_report(seen.expectations(f), os.path.join(rep, "expectations"))
    WR.write_report(seen.missingness(), os.path.join(rep, "missingness"))
    WR.write_report(Q.outliers(f), os.path.join(rep, "outliers"))
    WR.write_report(Q.date_gaps(f).filter("is_anomaly"), os.path.join(rep, "date_gap_anomalies"))
    row = Q.anomaly_summary(f).first()
    summary = spark.createDataFrame([row])
    WR.write_report(summary, os.path.join(rep, "anomaly_summary"))
    perf = B.slice_performance(f)
    WR.write_report(perf, os.path.join(rep, "slice_performance"), "csv")
    WR.write_report(B.mitigation_plan(perf), os.path.join(rep, "mitigation_plan"))
    WR.write_report(B.bias_summary(perf), os.path.join(rep, "bias_summary"))
    row = row.asDict()
    row["data_changed"] = changed
    if fail_on_anomalies:
        Q.anomaly_gate(summary, max_anomalies)
    return row


def candidate(choice: DataFrame, versions: DataFrame) -> DataFrame:
    """The winner as the next version of its model (1 for a new model)."""
    newest = versions.groupBy("model").agg(F.max("version").alias("v"))
    return choice.select(F.col("winner").alias("model"), F.col("winner_mae").alias("test_mae")) \
        .join(newest, "model", "left").select("model", (F.coalesce("v", F.lit(0)) + 1).alias("version"), "test_mae")


def model_job(spark: SparkSession, features_path: str, out_dir: str, series_trials: int = 50, gbt_params: dict | None = None,
              versions: DataFrame | None = None, tree_trials: int = 0, tree_space: dict | None = None) -> DataFrame:
    """Split -> adaptive searches -> per-series and tree fits -> metrics -> champion choice and promotion -> stored
    models -> slice audit -> importance and attribution.  Returns the metrics table.

    ``tree_trials`` searches the tree model's parameters too (50 in the source); ``gbt_params`` are its fixed ones.
    Searches resume from ``<out_dir>/search`` after a kill.  Every run's models are stored as their next version;
    :func:`score_job` uses those in Production.
    """
    with released(spark):
        return _model(spark, features_path, out_dir, series_trials, gbt_params, versions, tree_trials, tree_space)


def _model(spark, features_path, out_dir, series_trials, gbt_params, versions, tree_trials, tree_space) -> DataFrame:
    f = spark.read.parquet(features_path)
    sp = SP.chronological_split(f)
    WR.write_splits(sp, os.path.join(out_dir, "splits"))
    sp = spark.read.parquet(os.path.join(out_dir, "splits"))
    part = {s: sp.filter(F.col("split") == s) for s in ("train", "val", "test")}
    current = versions if versions is not None else spark.createDataFrame(
        [], "model string, version int, stage string, test_mae double")
    run = 1 + (current.agg(F.max("version")).first()[0] or 0)
    search = os.path.join(out_dir, "search", f"run={run}")

    trials = TU.search_seasonal(part["train"], os.path.join(search, "seasonal"), n_trials=series_trials)
    series_params = _best(trials, SE.SPACE)
    coefficients = SE.fit_series(part["train"], series_params)
    coefficients.write.mode("overwrite").parquet(os.path.join(out_dir, "models", "seasonal", f"v={run}"))
    coefficients = spark.read.parquet(os.path.join(out_dir, "models", "seasonal", f"v={run}"))
    held_out = sp.filter(F.col("split").isin("val", "test"))
    seasonal = SE.predict_series(coefficients, held_out)

    params = dict(gbt_params or {})
    if tree_trials:
        found = TU.search_trees(part["train"], C.TRAIN_FEATURES, os.path.join(search, "tree"), tree_trials, space=tree_space)
        trials = trials.unionByName(found)
        best = _best(found, tree_space or TU.TREE_SPACE)
        params |= best | ({"featureSubsetStrategy": str(best["featureSubsetStrategy"])} if "featureSubsetStrategy" in best else {})
    trials.write.mode("overwrite").parquet(os.path.join(out_dir, "trials"))
    pipeline = MS.fit_pipeline(part["train"], part["val"], params=params)
    MS.save(spark, pipeline, os.path.join(out_dir, "models"), "tree", run, params={k: str(v) for k, v in params.items()})
    MS.score(pipeline, held_out).write.mode("overwrite").parquet(os.path.join(out_dir, "predictions"))
    tree = spark.read.parquet(os.path.join(out_dir, "predictions"))

    metrics = (B.regression_metrics(seasonal, pred="prediction", group=["split"]).withColumn("model", F.lit("seasonal"))
               .unionByName(B.regression_metrics(tree, pred="prediction", group=["split"])
                            .withColumn("model", F.lit("tree"))))
    metrics.write.mode("overwrite").parquet(os.path.join(out_dir, "metrics"))
    metrics = spark.read.parquet(os.path.join(out_dir, "metrics"))
    choice = R.select_model(metrics, ["tree", "seasonal"])
    WR.write_report(choice, os.path.join(out_dir, "reports", "selection"))
    # all of a run's models carry its number, so the winner's version names what was stored
    new = choice.select(F.col("winner").alias("model"), F.lit(run).alias("version"), F.col("winner_mae").alias("test_mae"))
    R.promote(current, new).write.mode("overwrite").parquet(os.path.join(out_dir, "versions"))
    WR.write_report(B.model_slice_bias(tree.filter(F.col("split") == "test"), pred="prediction"),
                    os.path.join(out_dir, "reports", "model_slice_bias"))
    WR.write_report(FC.feature_importance(pipeline_of_trees(pipeline), C.TRAIN_FEATURES), os.path.join(out_dir, "reports", "importance"))
    keys = ["store_id", "product_id", "as_of_date"]
    WR.write_report(AT.mean_attribution(AT.explain(pipeline, AT.attribution_sample(part["test"], keys), keys)),
                    os.path.join(out_dir, "reports", "attribution"))
    return metrics


def pipeline_of_trees(pipeline: PipelineModel) -> PipelineModel:
    """The last two stages: what names the features and what splits on them."""
    return PipelineModel(pipeline.stages[-2:])


def _best(trials: DataFrame, space: dict) -> dict:
    row = trials.filter(F.col("state") == "COMPLETE").orderBy("mae", "trial").first()
    return {k: TU.typed(space[k], v) for k, v in row["params"].items()} if row else {}


def score_job(spark: SparkSession, retail: DataFrame, snapshot: DataFrame, model_dir: str, model: str = "tree") -> DataFrame:
    """The next day's demand of every series, from the stored model that is in Production.

    The tree scores the last row of each series as the training transform makes it; the seasonal model's
    regressors are of that row too, its date is the target date.
    """
    versions = spark.read.parquet(os.path.join(model_dir, "versions"))
    root = os.path.join(model_dir, "models")
    if model == "tree":
        stored = MS.load_production(spark, root, versions, model)
        rows = FE.features_v2(retail, snapshot, horizon=stored.meta["horizon"], include_created_at=False, rows="latest",
                              **stored.meta["code_maps"])
        return MS.score(stored.pipeline, rows).select("store_id", "product_id", F.date_add("as_of_date", stored.meta["horizon"])
                                                      .alias("target_date"), "predicted_demand")
    coefficients = spark.read.parquet(MS.version_path(root, model, MS.production_version(versions, model)))
    rows = FE.features_v2(retail, snapshot, include_created_at=False, rows="latest")
    return SE.predict_series(coefficients, rows.withColumn("as_of_date", F.date_add("as_of_date", 1))).select(
        "store_id", "product_id", F.col("as_of_date").alias("target_date"), FC.predicted_demand("prediction").alias("predicted_demand"))

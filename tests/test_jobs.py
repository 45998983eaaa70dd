import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from shelfcast import jobs
from shelfcast.operators import features as FE
from shelfcast.sources import readers as RD
from shelfcast.sources import testdata as T


def test_daily_and_model_jobs(spark, sf_dir):
    out = tempfile.mkdtemp(prefix="jobs-")
    retail, snap = T.retail_daily(spark, sf_dir), T.inventory_snapshot(spark, sf_dir)
    s1 = jobs.daily_features_job(spark, retail, snap, out, "r1")
    shared = spark.conf.get("spark.checkpoint.dir")
    before = {d for d in os.listdir(shared) if d.startswith("stage-")}
    s2 = jobs.daily_features_job(spark, retail, snap, out, "r2")
    assert {d for d in os.listdir(shared) if d.startswith("stage-")} <= before      # nothing staged is left behind
    assert s1["data_changed"] and not s2["data_changed"]
    assert "total_anomaly_types" in s1
    for r in ("stats", "expectations", "missingness", "outliers", "anomaly_summary", "slice_performance",
              "mitigation_plan", "bias_summary", "schema"):
        assert os.path.isdir(os.path.join(out, "reports", r)), r
    s3 = jobs.daily_features_job(spark, retail, snap, os.path.join(out, "b"), "r1", table="job_features", buckets=4)
    assert s3["total_anomaly_types"] == s1["total_anomaly_types"]
    assert spark.table("job_features").count() == spark.read.parquet(os.path.join(out, "features")).count()
    spark.sql("DROP TABLE job_features")
    m = jobs.model_job(spark, os.path.join(out, "features"), os.path.join(out, "model"), series_trials=2,
                       gbt_params={"maxIter": 10})
    got = {(r["model"], r["split"]) for r in m.collect()}
    assert got == {("seasonal", "val"), ("seasonal", "test"), ("tree", "val"), ("tree", "test")}
    v = spark.read.parquet(os.path.join(out, "model", "versions")).collect()
    assert len(v) == 1 and v[0]["stage"] == "Production"
    assert os.path.isdir(os.path.join(out, "model", "reports", "attribution"))
    # the stored model in Production scores every series, one day after its last row
    got = jobs.score_job(spark, retail, snap, os.path.join(out, "model"), v[0]["model"]).collect()
    last = {(r[0], r[1]): r[2] for r in retail.groupBy("store_id", "product_id").agg(F.max("date")).collect()}
    assert len(got) == len(last) and all(r["predicted_demand"] >= 0 for r in got)
    assert all(r["target_date"] == last[r["store_id"], r["product_id"]] + dt.timedelta(days=1) for r in got)
    # a second run stores the next version, whatever wins
    again = jobs.model_job(spark, os.path.join(out, "features"), os.path.join(out, "model"), series_trials=2, gbt_params={"maxIter": 10},
                           versions=spark.createDataFrame([("tree", 1, "Production", 1e9)], "model string, version int, stage string, test_mae double"),
                           tree_trials=2, tree_space={"maxDepth": ("int", 2, 3), "stepSize": ("log", 0.1, 0.3)})
    assert again.count() == 4
    for model in ("tree", "seasonal"):
        assert sorted(os.listdir(os.path.join(out, "model", "models", model))) == ["v=1", "v=2"]
    trials = spark.read.parquet(os.path.join(out, "model", "trials")).groupBy("model").count().collect()
    assert {(r["model"], r["count"]) for r in trials} == {("seasonal", 2), ("gbt", 2)}


def test_daily_job_keeps_the_first_of_conflicting_rows(spark, sf_dir):
    base = tempfile.mkdtemp(prefix="jobs-")
    retail, snap = T.retail_daily(spark, sf_dir), T.inventory_snapshot(spark, sf_dir)
    later = retail.withColumn("units_sold", F.col("units_sold") + 1000)
    src = os.path.join(base, "csv")
    # one file per delivery; the second one contradicts the first on every day
    for name, d in (("a", retail), ("b", later)):
        d.coalesce(1).write.option("header", True).csv(os.path.join(src, name))
    raw = RD.read_retail(spark, os.path.join(src, "*"), fmt="csv", ingest_order=True)
    jobs.daily_features_job(spark, raw, snap, os.path.join(base, "out"), "r1")
    got = spark.read.parquet(os.path.join(base, "out", "features"))
    want = FE.features_v2(retail, snap, include_created_at=False)
    cols = ["store_id", "product_id", "as_of_date", "sales_lag_1", "sales_roll_mean_7", "y"]
    assert sorted(got.select(*cols).collect()) == sorted(want.select(*cols).collect())
    assert got.agg(F.max("y")).first()[0] < 1000


def test_second_run_makes_the_next_version(spark):
    from shelfcast.operators import registry as R
    none = spark.createDataFrame([], "model string, version int, stage string, test_mae double")
    first = spark.createDataFrame([("tree", 10.0)], "winner string, winner_mae double")
    one = R.promote(none, jobs.candidate(first, none))
    second = spark.createDataFrame([("tree", 5.0)], "winner string, winner_mae double")
    two = R.promote(one, jobs.candidate(second, one))
    assert sorted((r["model"], r["version"], r["stage"]) for r in two.collect()) == [
        ("tree", 1, "Archived"), ("tree", 2, "Production")]

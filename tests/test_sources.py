import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import forecast as FC
from shelfcast.sources import readers as RD
from shelfcast.sources import writers as WR


def test_json_shapes(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "arr.json"), "w") as f:
        json.dump([{"a": 1}, {"a": 2}], f)
    with open(os.path.join(d, "wrap.json"), "w") as f:
        json.dump({"meta": "x", "rows": [{"a": 3}, {"a": 4}, {"a": 5}]}, f)
    with open(os.path.join(d, "one.json"), "w") as f:
        json.dump({"a": 6}, f)
    assert sorted(r["a"] for r in RD.read_json(spark, os.path.join(d, "arr.json")).collect()) == [1, 2]
    assert sorted(r["a"] for r in RD.read_json(spark, os.path.join(d, "wrap.json")).collect()) == [3, 4, 5]
    assert [r["a"] for r in RD.read_json(spark, os.path.join(d, "one.json")).collect()] == [6]


def test_csv_blank_is_null_and_names_conformed(spark):
    d = tempfile.mkdtemp()
    p = os.path.join(d, "snap.csv")
    with open(p, "w") as f:
        f.write(" Store ID ,Product ID,Category,Region,Current Stock,Total Units Sold,Total Units Received,"
                "Lead Time Days\nS001,P0001,Snacks,West,,10,20,3\n")
    s = RD.read_snapshot(spark, p, fmt="csv")
    r = s.first()
    assert r["store_id"] == "S001" and r["current_stock"] is None and r["lead_time_days"] == 3


def _json(d, name, value):
    with open(os.path.join(d, name), "w") as f:
        json.dump(value, f)


def test_json_layout_depends_on_each_file_alone(spark):
    d = tempfile.mkdtemp()
    order = {"order_id": 1, "items": [{"p": "a"}, {"p": "b"}]}
    _json(d, "one.json", [order])                       # an array of one stays an array
    _json(d, "two.json", [order, order])
    _json(d, "wrap.json", {"zeta": [{"order_id": 7}], "alpha": [{"order_id": 8}]})  # first list in the document wins
    one = RD.read_json(spark, os.path.join(d, "one.json")).collect()
    assert [(r["order_id"], len(r["items"])) for r in one] == [(1, 2)]
    both = RD.read_json(spark, os.path.join(d, "*.json"), "order_id long").collect()
    assert sorted(r["order_id"] for r in both) == [1, 1, 1, 7]
    _json(d, "scalars.json", {"name": "x", "values": [1, 2.5, "t"]})
    assert [r["value"] for r in RD.read_json(spark, os.path.join(d, "scalars.json")).collect()] == ["1", "2.5", "t"]


def test_json_elements_as_variants(spark):
    d = tempfile.mkdtemp()
    _json(d, "deep.json", [{"a": 1, "b": {"c": [1, 2.5], "VOID": None}, "d e": "x"}, {"a": None, "b": {"c": []}, "list": [[1], [2, 3]]},
                           {"a": 7, "mix": 1}, {"mix": {"k": "v"}}])
    out = RD.read_json(spark, os.path.join(d, "deep.json"))
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "ExistingRDD" not in plan
    rows = [r.asDict(recursive=True) for r in out.collect()]
    assert [r["a"] for r in rows] == [1, None, 7, None] and rows[0]["b"]["c"] == [1.0, 2.5] and rows[0]["d e"] == "x"
    assert rows[1]["list"] == [[1], [2, 3]] and rows[1]["b"]["c"] == [] and rows[0]["b"]["VOID"] is None
    assert rows[2]["mix"] == "1" and json.loads(rows[3]["mix"]) == {"k": "v"}


def test_json_mixed_elements_are_kept(spark):
    d = tempfile.mkdtemp()
    _json(d, "mixed.json", {"rows": [1, "two", {"a": 3}, [4, 5], None, 2.5]})
    out = RD.read_json(spark, os.path.join(d, "mixed.json"))
    assert out.columns == ["value"]
    got = [r["value"] for r in out.collect()]
    assert got[:2] == ["1", "two"] and json.loads(got[2]) == {"a": 3} and json.loads(got[3]) == [4, 5] and got[4] is None and got[5] == "2.5"
    with pytest.raises(ValueError):
        RD.read_json(spark, os.path.join(d, "mixed.json"), "a long")
    _json(d, "nested.json", [[1, 2], [{"x": 1}]])
    assert [json.loads(r["value"]) for r in RD.read_json(spark, os.path.join(d, "nested.json")).collect()] == [[1, 2], [{"x": 1}]]


def test_reports_over_a_bucketed_table_need_no_exchange(spark, sf_dir):
    from shelfcast.operators import features as FE
    from shelfcast.operators import quality as Q
    from shelfcast.sources import testdata as T
    base = tempfile.mkdtemp()
    f = FE.features_v2(T.retail_daily(spark, sf_dir), T.inventory_snapshot(spark, sf_dir), include_created_at=False)
    path = os.path.join(base, "features")
    WR.write_bucketed(f, "bucketed_features", path, 4)
    stored = spark.table("bucketed_features")
    gaps = Q.date_gaps(stored)
    plan = gaps._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    want = sorted(map(str, Q.date_gaps(f).collect()))
    assert sorted(map(str, gaps.collect())) == want
    files = [x for x in os.listdir(path) if x.endswith(".parquet")]
    assert len(files) <= 4
    # another session knows the folder only
    again = WR.open_bucketed(spark, "bucketed_again", path, ", ".join(f"`{c}` {t}" for c, t in f.dtypes), 4)
    assert "Exchange" not in Q.date_gaps(again)._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, Q.date_gaps(again).collect())) == want
    for t in ("bucketed_features", "bucketed_again"):
        spark.sql(f"DROP TABLE {t}")


def test_reports_are_observed_by_the_write(spark, sf_dir):
    from shelfcast.operators import features as FE
    from shelfcast.operators import quality as Q
    from shelfcast.sources import testdata as T
    f = FE.features_v2(T.retail_daily(spark, sf_dir), T.inventory_snapshot(spark, sf_dir), include_created_at=False)
    f = f.withColumn("gap", F.when(F.col("dow") == 2, 1.0)).withColumn("price", F.col("effective_price") - 20)
    path = os.path.join(tempfile.mkdtemp(), "f")
    seen = Q.Observed()
    seen.watch(f).write.parquet(path)
    stored = spark.read.parquet(path).select(*f.columns)
    norm = lambda d: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in d.fillna("-").collect())
    key = lambda d: sorted(map(str, norm(d)))
    assert key(seen.missingness()) == key(Q.missingness(stored))
    assert key(seen.expectations(stored)) == key(Q.expectations(stored))
    a, b = (d.toPandas().set_index("column").sort_index() for d in (seen.column_stats(), Q.column_stats(stored)))
    assert (a.index == b.index).all() and a["null_pct"].equals(b["null_pct"])
    assert ((a[["mean", "std", "min", "max"]] - b[["mean", "std", "min", "max"]]).abs().max() < 1e-6).all()
    assert a["mean"].isna().equals(b["mean"].isna())


def test_extract_if_changed_reuses_copy(spark):
    base = tempfile.mkdtemp()
    df = spark.createDataFrame([("2022-01-01", 1), ("2022-01-02", 2)], "date string, v int") \
              .withColumn("date", F.to_date("date"))
    a, changed1 = RD.extract_if_changed(df, base, "r1")
    b, changed2 = RD.extract_if_changed(df, base, "r2")
    assert changed1 and not changed2 and b.count() == 2
    more = df.unionByName(spark.createDataFrame([("2022-01-03", 3)], "date string, v int")
                          .withColumn("date", F.to_date("date")))
    c, changed3 = RD.extract_if_changed(more, base, "r3")
    assert changed3 and c.count() == 3


def test_writers_layouts(spark):
    base = tempfile.mkdtemp()
    df = spark.createDataFrame([("S1", "train", 1), ("S2", "test", 2)], "store_id string, split string, v int")
    WR.write_features(df, os.path.join(base, "f"))
    WR.write_splits(df, os.path.join(base, "s"))
    assert {"store_id=S1", "store_id=S2"} <= set(os.listdir(os.path.join(base, "f")))
    assert spark.read.parquet(os.path.join(base, "s")).filter("split = 'test'").count() == 1


def test_feature_matrix_codes_strings(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0), ("c", 3.0), ("a", 4.0)], "cat string, x double")
    m = {r["x"]: r["cat"] for r in FC.feature_matrix(df, ["cat", "x", "missing"]).collect()}
    assert m == {1.0: 1, 2.0: 0, 3.0: 2, 4.0: 0}


def test_reports_gate_schema_and_contacts(spark):
    import pytest
    from shelfcast.operators import orders as OR
    from shelfcast.operators import quality as Q
    base = tempfile.mkdtemp()
    df = spark.createDataFrame([("a", 1.0), ("b", None)], "k string, x double")
    assert Q.schema_dump(df) == [("k", "string"), ("x", "double")]
    m = Q.missingness(df)
    WR.write_report(m, os.path.join(base, "miss"), "json")
    WR.write_report(m, os.path.join(base, "miss_csv"), "csv")
    assert spark.read.json(os.path.join(base, "miss")).count() == 2
    summary = spark.createDataFrame([(2, 1, 1, 0, True)], "total_anomaly_types int, missingness_anomalies int, "
                                    "outlier_anomalies int, date_gap_anomalies int, has_critical_anomalies boolean")
    assert Q.anomaly_gate(summary, max_anomalies=5)["total_anomaly_types"] == 2
    with pytest.raises(RuntimeError):
        Q.anomaly_gate(summary, max_anomalies=0)
    sub = spark.createDataFrame([("n", "e@x", "s", "m", "u1")], "name string, email string, subject string, "
                                "message string, user_id string")
    p = os.path.join(base, "contacts")
    OR.record_contacts(sub, p)
    OR.record_contacts(sub, p)
    got = spark.read.parquet(p)
    assert got.count() == 2 and "created_at" in got.columns


def test_reports_are_written_by_the_tasks_that_hold_the_rows(spark):
    d = tempfile.mkdtemp()
    WR.write_report(spark.range(100).repartition(5), os.path.join(d, "r"))
    assert spark.read.json(os.path.join(d, "r")).count() == 100
    assert sum(f.startswith("part-") for f in os.listdir(os.path.join(d, "r"))) == 5

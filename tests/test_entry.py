import os

import duckdb

import __spark_entry__ as E
from shelfcast.sources.testdata import TABLES

ORACLE_SAMPLE = ["features_v2", "inventory_kpis", "stock_health", "slice_performance", "order_totals",
                 "scoring_features", "walk_forward_folds", "conversation_title"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "sales_ewm_28" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_oracle_sample_at_smallest_scale(spark, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sql = E.queries(), E.oracle_sql()
    for name in ORACLE_SAMPLE:
        sdf = qs[name](spark, sf_dir)
        cur = con.execute(sql[name])
        dcols = [d[0] for d in cur.description]
        drows = cur.fetchall()
        assert sorted(sdf.columns) == sorted(dcols), name
        assert sdf.count() == len(drows), name

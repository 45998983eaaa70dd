"""Headline-query benchmark.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs each headline query of the catalog to completion (``noop`` sink: the
whole plan executes, nothing is collected) and prints ONE JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}.
A short warm-up on the smallest test folder goes first (JVM start and code
generation are not counted).  Each query's time is the best of ``BENCH_REPS``
runs (default 2).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfcast.plans import catalog  # noqa: E402
from shelfcast.session import get_spark  # noqa: E402

HEADLINE = [
    "features_v2",          # join + 12 windows + native EWM + weights
    "features_v1",
    "inventory_kpis",
    "insight_cards",
    "health_trend",
    "inventory_facets",
    "anomaly_summary",      # missingness + percentiles + gaps
    "column_stats",
    "slice_performance",
    "mitigation_plan",
    "chronological_split",
    "walk_forward_folds",
    "series_encoding",
    "scaled_features",
    "scoring_features",
    "order_totals",
    "orders_placed",
    "conversation_list",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "2"))
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2),
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m"})
    qs = catalog.queries()
    names = [n for n in HEADLINE if n in qs]
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        for n in names[:3]:
            qs[n](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        best = None
        for _ in range(reps):
            t0 = time.perf_counter()
            qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[n] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_queries_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

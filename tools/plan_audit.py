"""Audit the physical plans of every catalog query.

    python tools/plan_audit.py [--sf /root/testdata/sf0.001]

Prints, per query, the counts of plan nodes worth watching at scale: Python
evaluation (row UDFs, Arrow UDFs, grouped pandas), Cartesian products and
nested-loop joins, unkeyed (single-partition) windows, sort-merge joins,
windows and per-group limits.  Exits non-zero if a query outside the model
family evaluates Python or any query plans a Cartesian product, a
nested-loop join or an unkeyed window.
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfcast.plans import catalog  # noqa: E402
from shelfcast.session import get_spark  # noqa: E402

WATCH = ["BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "CartesianProduct",
         "BroadcastNestedLoopJoin", "SortMergeJoin", "BroadcastHashJoin", "WindowGroupLimit", "Window ",
         "Exchange"]
PYTHON_OK = {"seasonal_forecast", "seasonal_metrics", "seasonal_tuning"}
SKIP = {"gbt_forecast", "gbt_importance", "gbt_permutation_importance", "intent_routing"}  # fit at call time


def unkeyed_windows(plan: str) -> int:
    """Windows fed by a single-partition exchange (walk up the explain tree)."""
    lines = plan.splitlines()
    found = 0
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" not in line:
            continue
        depth = len(line) - len(line.lstrip(" :+-"))
        for j in range(i - 1, max(-1, i - 12), -1):
            d = len(lines[j]) - len(lines[j].lstrip(" :+-"))
            if d < depth:
                depth = d
                if "Window [" in lines[j]:
                    found += 1
                    break
                if "Sort [" not in lines[j] and "Project [" not in lines[j]:
                    break
    return found


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.001")
    a = ap.parse_args()
    spark = get_spark("local[4]", 4)
    bad = []
    for name, fn in sorted(catalog.queries().items()):
        if name in SKIP:
            continue
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, a.sf).explain("simple")
        txt = buf.getvalue()
        hits = {w.strip(): txt.count(w) for w in WATCH if w in txt}
        unkeyed = unkeyed_windows(txt)
        if unkeyed:
            hits["UnkeyedWindow"] = unkeyed
        print(f"{name:30s} {hits}")
        py = any(k in hits for k in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"))
        if (py and name not in PYTHON_OK) or "CartesianProduct" in hits or "BroadcastNestedLoopJoin" in hits \
                or "UnkeyedWindow" in hits:
            bad.append(name)
    print("flagged:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())

"""Query catalog: name -> (spark, sf_dir) -> DataFrame, and name -> oracle SQL.

Each family module registers its queries with ``register``; the entry module
of the repository exposes the two dicts to the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}
_LOADED = False


def _bigint_counts(sql: str) -> str:
    """DuckDB's ``count_if`` returns HUGEINT; Spark's returns BIGINT: cast each call."""
    out, i, key = [], 0, "count_if("
    low = sql.lower()
    while True:
        j = low.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(key) - 1
        while k < len(sql):
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            if depth == 0:
                break
            k += 1
        inner = _bigint_counts(sql[j + len(key):k])
        out.append(sql[i:j] + f"CAST(count_if({inner}) AS BIGINT)")
        i = k + 1


def register(name: str, sql: str | None = None):
    """Decorator: add a query (and its DuckDB oracle, if SQL can express it)."""
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = _bigint_counts(sql)
        return fn
    return deco


def _load() -> None:
    global _LOADED
    if _LOADED:
        return
    # Importing the family modules (plans/q_*.py) fills the registries.
    import importlib
    import pkgutil

    import shelfcast.plans as plans
    for m in sorted(pkgutil.iter_modules(plans.__path__), key=lambda m: m.name):
        if m.name.startswith("q_"):
            importlib.import_module(f"shelfcast.plans.{m.name}")
    _LOADED = True


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)

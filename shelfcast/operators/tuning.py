"""Adaptive search with successive halving over walk-forward folds, resumable from its trials table.

* **Proposals.**  Finished trials are ranked; each parameter has a density of the good ones and one of the rest (a kernel
  on each value and a flat one, in the parameter's own scale), and of a number of draws from the good density
  the one with the largest ratio of the two is tried (tree-structured density ratio).  The first batch is random.
* **Halving.**  The folds are rungs: a batch of trials is evaluated on the first fold, the better half on the next, and so on.
  A trial that leaves is PRUNED; the one that reaches the last fold is COMPLETE.
* **State.**  Each rung's results are written to ``path`` before the next begins.  Proposals depend on the seed and the
  results so far only, so a search that was killed proposes the same again and takes what is there from the table.

The table holds a few rows per batch; the fits are Spark jobs.
"""

from __future__ import annotations

import math
import os
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast import config as C
from shelfcast.operators import boosting as BO
from shelfcast.operators import forecast as FC
from shelfcast.operators import seasonal as SE
from shelfcast.sources.readers import partition_values

# FIXED VALUES: ranges of the source's tree search (L1 and L2 penalties have no counterpart in Spark's trees).
TREE_SPACE = {"maxDepth": ("int", 3, 10), "stepSize": ("log", 0.01, 0.3), "maxIter": ("int", 100, 800),
              "subsamplingRate": ("float", 0.5, 1.0), "featureSubsetStrategy": ("float", 0.4, 1.0),
              "minInstancesPerNode": ("int", 1, 20), "minInfoGain": ("float", 0.0, 5.0)}
CANDIDATES, STARTUP, MOST_GOOD = 24, 8, 25
ROWS = "trial int, mae double, params map<string,string>"


def to_unit(spec: tuple, value) -> float:
    kind, lo, hi = spec[0], *([0, len(spec[1]) - 1] if spec[0] == "choice" else spec[1:])
    if kind == "choice":
        value = spec[1].index(value)
    if kind == "log":
        lo, hi, value = math.log(lo), math.log(hi), math.log(value)
    return (value - lo) / (hi - lo) if hi > lo else 0.5


def from_unit(spec: tuple, u: float):
    kind = spec[0]
    u = min(max(u, 0.0), 1.0)
    if kind == "choice":
        return spec[1][min(int(u * len(spec[1])), len(spec[1]) - 1)]
    lo, hi = spec[1:]
    if kind == "log":
        return math.exp(math.log(lo) + u * (math.log(hi) - math.log(lo)))
    return lo + min(int(u * (hi - lo + 1)), hi - lo) if kind == "int" else lo + u * (hi - lo)


def _kernels(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres and widths: a kernel on each point, as wide as the larger gap to its neighbours, and one over the whole range."""
    at = np.sort(np.append(points, 0.5))
    edges = np.concatenate([[0.0], at, [1.0]])
    width = np.maximum(edges[1:-1] - edges[:-2], edges[2:] - edges[1:-1])
    width = np.clip(width, 1.0 / min(100, len(at) + 1), 1.0)
    width[int(np.argmin(np.abs(at - 0.5)))] = 1.0
    return at, width


def _phi(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.vectorize(math.erf)(z / math.sqrt(2)))


def _density(points: np.ndarray, u: np.ndarray) -> np.ndarray:
    at, width = _kernels(points)
    z = (u[:, None] - at) / width
    inside = width * (_phi((1 - at) / width) - _phi(-at / width))  # what a kernel has within the range
    return (np.exp(-z * z / 2) / (math.sqrt(2 * math.pi) * inside)).mean(1)


def _sample(points: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    at, width = _kernels(points)
    pick = rng.integers(0, len(at), n)
    out = at[pick] + width[pick] * rng.normal(size=n)
    for _ in range(20):
        bad = (out < 0) | (out > 1)
        out = np.where(bad, at[pick] + width[pick] * rng.normal(size=n), out)
    return np.clip(out, 0, 1)


def propose(space: dict, ranked: list[dict], pending: list[dict], rng: np.random.Generator) -> dict:
    """A trial from the density ratio of the good and the other trials (``ranked``: best first); random without any.

    Trials that are out but not back yet count with the others, so a batch does not ask one thing twice.
    """
    if not ranked:
        return {k: from_unit(s, rng.random()) for k, s in space.items()}
    n = min(MOST_GOOD, max(2, math.ceil(0.15 * len(ranked))))
    good, rest = ranked[:n], ranked[n:] + pending
    score, draws = np.zeros(CANDIDATES), {}
    for k, s in space.items():
        if s[0] == "choice":
            share = [np.array([sum(t[k] == v for t in ts) + 1.0 for v in s[1]]) for ts in (good, rest)]
            share = [c / c.sum() for c in share]
            pick = rng.choice(len(s[1]), CANDIDATES, p=share[0])
            score += np.log(share[0][pick]) - np.log(share[1][pick])
            draws[k] = [s[1][i] for i in pick]
            continue
        a, b = (np.array([to_unit(s, t[k]) for t in ts]) for ts in (good, rest))
        u = _sample(a, CANDIDATES, rng)
        score += np.log(_density(a, u)) - np.log(_density(b, u))
        draws[k] = [from_unit(s, float(v)) for v in u]
    best = int(np.argmax(score))
    return {k: draws[k][best] for k in space}


def typed(spec: tuple, text: str):
    return text if spec[0] == "choice" else int(text) if spec[0] == "int" else float(text)


def _order(history: dict[int, list[float | None]], trials: dict[int, dict]) -> list[dict]:
    """Trials best first, by their errors relative to the best one on the same rung (batches differ in what they keep)."""
    known = {n: errors for n, errors in history.items() if errors and all(e is not None for e in errors)}
    least = [min(errors[r] for errors in known.values() if len(errors) > r) for r in range(max(map(len, known.values()), default=0))]
    return [trials[n] for n in sorted(known, key=lambda n: (float(np.mean([e / (least[r] or 1.0) for r, e in enumerate(known[n])])), n))]


def search(spark: SparkSession, path: str, space: dict, evaluate: Callable[[list[tuple[int, dict]], int], dict[int, float | None]],
           rungs: int, n_trials: int = 50, batch: int = 8, seed: int = 42, model: str = "model") -> DataFrame:
    """The trials table (model, trial, state, mae, params, rungs) after ``n_trials`` trials.

    ``evaluate(trials, rung)`` gives the error of each trial on a rung (None: it failed).  ``path`` keeps the results.
    """
    trials: dict[int, dict] = {}
    history: dict[int, list[float | None]] = {}
    for b, first in enumerate(range(0, n_trials, batch)):
        rng = np.random.default_rng([seed, b])
        ranked, pending = _order(history, trials), []
        for _ in range(min(batch, n_trials - first)):
            pending.append(propose(space, ranked if len(ranked) >= STARTUP else [], pending, rng))
        alive = list(range(first, first + len(pending)))
        trials |= dict(zip(alive, pending, strict=True))
        history |= {n: [] for n in alive}
        for rung in range(rungs):
            for n, error in _rung(spark, path, space, trials, alive, b, rung, evaluate).items():
                history[n].append(error)
            alive = [n for n in alive if history[n][-1] is not None]
            if rung < rungs - 1:
                alive = sorted(sorted(alive, key=lambda n: (float(np.mean(history[n])), n))[:max(1, math.ceil(len(alive) / 2))])
            if not alive:
                break
    rows = []
    for n, errors in history.items():
        failed = not errors or errors[-1] is None
        state = "FAIL" if failed else "COMPLETE" if len(errors) == rungs else "PRUNED"
        rows.append((model, n, state, None if failed else float(np.mean(errors)), {k: str(v) for k, v in trials[n].items()}, len(errors)))
    return spark.createDataFrame(rows, "model string, trial int, state string, mae double, params map<string,string>, rungs int")


def _rung(spark: SparkSession, path: str, space: dict, trials: dict[int, dict], alive: list[int], b: int, rung: int, evaluate) -> dict:
    folder = os.path.join(path, f"batch={b}")
    if rung in partition_values(spark, folder, "rung"):
        stored = spark.read.parquet(os.path.join(folder, f"rung={rung}")).collect()
        for r in stored:  # what was tried is what the table says
            trials[r["trial"]] = {k: typed(space[k], v) for k, v in r["params"].items()}
        return {r["trial"]: r["mae"] for r in sorted(stored, key=lambda r: r["trial"])}
    got = {n: None if e is None else float(e) for n, e in evaluate([(n, trials[n]) for n in alive], rung).items()}
    rows = [(n, got[n], {k: repr(v) if isinstance(v, float) else str(v) for k, v in trials[n].items()}) for n in alive]
    # written aside and renamed, so a rung is there as a whole or not at all
    aside = os.path.join(folder, f"_rung={rung}")
    spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("overwrite").parquet(aside)
    jvm = spark.sparkContext._jvm
    source, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (aside, os.path.join(folder, f"rung={rung}")))
    source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(source, target)
    return {n: got[n] for n in alive}


def fits(trials: DataFrame) -> int:
    """Number of fits a search took."""
    return trials.agg(F.sum("rungs")).first()[0]


def search_seasonal(train: DataFrame, path: str, n_trials: int = 50, batch: int = 8, seed: int = 42, n_folds: int = C.N_FOLDS,
                    regressors=SE.SERIES_REGRESSORS) -> DataFrame:
    """The seasonal model's parameters, one job per rung for all trials of a batch and all series."""
    folds = [rows for _, rows in FC.fold_inputs(train, n_folds)]
    return search(train.sparkSession, path, SE.SPACE, lambda ts, rung: SE.trial_errors(folds[rung], ts, regressors),
                  len(folds), n_trials, batch, seed, "seasonal")


def tree_error(rows: DataFrame, features, params: dict, start: int = 50) -> float | None:
    """MAE on a prepared fold's validation rows, which also choose the number of rounds (as in the source)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    feats = [f for f in features if f in rows.columns]
    tr = rows.filter(F.col("role") == "train")
    sides, names = BO.missing_sides(tr, feats)
    p = {k: v for k, v in dict(FC.GBT_DEFAULTS, **params).items() if k != "validationTol"}
    p["featureSubsetStrategy"] = str(p["featureSubsetStrategy"])
    gbt = GBTRegressor(featuresCol="features", labelCol="y", predictionCol="raw_prediction", lossType="squared", **p)
    if "sample_weight" in rows.columns:
        gbt.setWeightCol("sample_weight")
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(sides.transform(rows.withColumn("y", F.col("y").cast("double"))))
    va = vectors.filter(F.col("role") == "val")
    model, _ = BO.fit_with_patience(gbt, vectors.filter(F.col("role") == "train"), va, start=start)
    error = F.avg(F.abs(F.greatest(F.col("raw_prediction"), F.lit(0.0)) - F.col("y")))
    return model.transform(va).agg(error).first()[0]


def search_trees(train: DataFrame, features, path: str, n_trials: int = 50, batch: int = 8, seed: int = 42,
                 n_folds: int = C.N_FOLDS, space: dict | None = None, threads: int = 4) -> DataFrame:
    """The tree model's parameters; ``threads`` trials of a rung are fitted at a time."""
    folds = [rows for _, rows in FC.fold_inputs(train, n_folds)]

    def evaluate(trials: list[tuple[int, dict]], rung: int) -> dict[int, float | None]:
        with ThreadPoolExecutor(max_workers=threads) as pool:
            return dict(zip([n for n, _ in trials], pool.map(lambda t: tree_error(folds[rung], features, t[1]), trials), strict=True))
    return search(train.sparkSession, path, space or TREE_SPACE, evaluate, len(folds), n_trials, batch, seed, "gbt")

"""One decomposable model per series, multiplicative (the default) or additive.

``trend(t) * (1 + effects)`` or ``trend(t) + effects``, with

* a piecewise linear trend whose slope may change at ``n_changepoints`` places in the first part of the
  history.  The changes have a Laplace prior, i.e. an L1 penalty: most of them come out as zero exactly, real
  breaks stay (active sets on the normal equations);
* effects: weekly and yearly Fourier terms and standardised regressors under normal priors (ridge).

The posterior mode is found in turns: given the trend the effects are a ridge problem, given the effects the trend
is an L1 problem, and the noise variance, which scales all penalties, follows from the residuals.

One group is one series (at most one row a day), fitted by ``applyInPandas``; what comes out is a table of one row
of coefficients per series.  Predictions are column expressions over that table joined to the rows, so scoring
needs no Python, and a stored table scores later rows (:func:`predict_series`).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast import config as C
from shelfcast.operators.forecast import SERIES_REGRESSORS

KEYS = ["store_id", "product_id"]
# FIXED VALUES: defaults and search ranges of the source's seasonal model
DEFAULTS = {"seasonality_mode": "multiplicative", "changepoint_prior_scale": 0.05, "seasonality_prior_scale": 10.0,
            "changepoint_range": 0.8, "n_changepoints": 25}
SPACE = {"changepoint_prior_scale": ("log", 0.001, 0.5), "seasonality_prior_scale": ("log", 0.01, 20.0),
         "seasonality_mode": ("choice", ("additive", "multiplicative")), "changepoint_range": ("float", 0.7, 0.95),
         "n_changepoints": ("int", 10, 40)}
WEEKLY, YEARLY = 3, 10
TREND_PRIOR = 5.0  # deviation of the prior on level and slope, in units of the largest value and the whole history

COEFFICIENTS = ("store_id string, product_id string, multiplicative boolean, origin date, span double, scale double, "
                "level double, slope double, changepoints array<double>, changes array<double>, effects array<double>, "
                "means array<double>, deviations array<double>, regressors array<string>, n_train long")


def lasso(gram: np.ndarray, target: np.ndarray, l1: np.ndarray, l2: np.ndarray, start: np.ndarray, steps: int = 1000) -> np.ndarray:
    """Minimum of ``x'Gx / 2 - t'x + sum l1 |x| + sum l2 x^2 / 2`` by active sets.

    With the signs of the active coordinates fixed the problem is linear.  Its solution is taken as far as no
    sign changes; a coordinate that reaches zero leaves.  Then the coordinate that violates its condition most
    enters.  Coordinate descent needs very many sweeps here, as neighbouring hinges are almost the same function.
    """
    h = gram + np.diag(l2 + 1e-12 * np.trace(gram) / len(gram))
    free = l1 == 0
    x, tolerance = start.copy(), 1e-9 * max(1.0, float(np.abs(target).max()))
    sign = np.where(free, 0.0, np.sign(x))
    active = free | (x != 0)
    for _ in range(steps):
        at = np.flatnonzero(active)
        z = np.linalg.solve(h[np.ix_(at, at)], target[at] - l1[at] * sign[at])
        crosses = ~free[at] & (z * sign[at] <= 0)
        if crosses.any():
            step = np.where(crosses, x[at] / np.where(x[at] == z, 1.0, x[at] - z), np.inf)
            first = int(np.argmin(step))
            x[at] += max(float(step[first]), 0.0) * (z - x[at])
            x[at[first]], sign[at[first]], active[at[first]] = 0.0, 0.0, False
            continue
        x[at] = z
        slope = target - h @ x
        violation = np.where(active, 0.0, np.abs(slope) - l1)
        j = int(np.argmax(violation))
        if violation[j] <= tolerance:
            break
        active[j], sign[j] = True, np.sign(slope[j])
    return x


def _fourier(days: np.ndarray) -> np.ndarray:
    cols = []
    for period, order in ((7.0, WEEKLY), (365.25, YEARLY)):
        for k in range(1, order + 1):
            cols += [np.sin(2 * np.pi * k * days / period), np.cos(2 * np.pi * k * days / period)]
    return np.stack(cols, axis=1)


def fit_one(days: np.ndarray, y: np.ndarray, x: np.ndarray, params: dict, rounds: int = 40) -> dict:
    """Coefficients of one series; ``days`` counts from its first row, ``x`` holds raw regressors."""
    p = dict(DEFAULTS, **params)
    span, scale = float(days.max()) or 1.0, float(np.abs(y).max()) or 1.0
    t, y = days / span, y / scale
    mult = p["seasonality_mode"] == "multiplicative"
    changepoints = np.linspace(0, float(p["changepoint_range"]), int(p["n_changepoints"]) + 1)[1:]
    changepoints = changepoints[changepoints < t.max()]
    mu, sd = x.mean(0), x.std(0)
    sd = np.where(sd > 0, sd, 1.0)
    effects_of = np.hstack([_fourier(days), (x - mu) / sd])
    trend_of = np.hstack([np.ones((len(t), 1)), t[:, None], np.maximum(0, t[:, None] - changepoints)])
    n, k = trend_of.shape
    trend, beta, noise = np.zeros(k), np.zeros(effects_of.shape[1]), float(y.var()) or 1e-6
    trend[0] = y.mean()
    free = np.arange(k) < 2
    last = None
    for _ in range(rounds):
        g = trend_of @ trend
        a = effects_of * g[:, None] if mult else effects_of
        ridge = noise / float(p["seasonality_prior_scale"]) ** 2
        beta = np.linalg.solve(a.T @ a + ridge * np.eye(a.shape[1]) + 1e-10 * np.eye(a.shape[1]), a.T @ (y - g))
        s = effects_of @ beta
        b, target = (trend_of * (1 + s)[:, None], y) if mult else (trend_of, y - s)
        l1 = np.where(free, 0.0, noise / float(p["changepoint_prior_scale"]))
        trend = lasso(b.T @ b, b.T @ target, l1, np.where(free, noise / TREND_PRIOR**2, 0.0), trend)
        g = trend_of @ trend
        fitted = g * (1 + s) if mult else g + s
        noise = max(float(((y - fitted) ** 2).mean()), 1e-8)
        if last is not None and np.abs(fitted - last).max() < 1e-6:
            break
        last = fitted
    return {"multiplicative": mult, "span": span, "scale": scale, "level": float(trend[0]), "slope": float(trend[1]),
            "changepoints": changepoints.tolist(), "changes": trend[2:].tolist(), "effects": beta.tolist(),
            "means": mu.tolist(), "deviations": sd.tolist()}


def _fit_group(pdf: pd.DataFrame, params: dict, regressors: Sequence[str], min_rows: int, keys: Sequence[str]) -> pd.DataFrame:
    names = [c.split(" ")[0] for c in COEFFICIENTS.split(", ")]
    if len(pdf) < min_rows:
        return pd.DataFrame(columns=[*keys, *[n for n in names if n not in keys]])
    pdf = pdf.sort_values("as_of_date")
    date = pd.to_datetime(pdf["as_of_date"])
    days = (date - date.iloc[0]).dt.days.to_numpy(float)
    x = pdf[list(regressors)].astype(float).fillna(0.0).to_numpy() if regressors else np.zeros((len(pdf), 0))
    got = fit_one(days, pdf["y"].astype(float).clip(lower=0).to_numpy(), x, params)
    row = {**{k: pdf[k].iloc[0] for k in keys}, "store_id": pdf["store_id"].iloc[0], "product_id": pdf["product_id"].iloc[0],
           "origin": date.iloc[0].date(), "n_train": len(pdf), "regressors": list(regressors), **got}
    return pd.DataFrame([row])[[*keys, *[n for n in names if n not in keys]]]


def fit_series(train: DataFrame, params: dict | None = None, regressors: Sequence[str] = SERIES_REGRESSORS,
               min_rows: int = C.MIN_SERIES_HISTORY) -> DataFrame:
    """One row of coefficients per series with at least ``min_rows`` rows."""
    regs = [r for r in regressors if r in train.columns]
    p = dict(params or {})
    data = train.filter(F.col("y").isNotNull()).select(*KEYS, "as_of_date", "y", *regs)
    return data.groupBy(*KEYS).applyInPandas(lambda pdf: _fit_group(pdf, p, regs, min_rows, KEYS), COEFFICIENTS)


def _value(regressors: Sequence[str]) -> Column:
    """The model's value as an expression over a row and its series' coefficients."""
    days = F.datediff("as_of_date", "origin").cast("double")
    t = days / F.col("span")
    bends = F.aggregate(F.zip_with("changepoints", "changes", lambda c, d: d * F.greatest(t - c, F.lit(0.0))), F.lit(0.0), lambda a, v: a + v)
    trend = F.col("level") + F.col("slope") * t + bends
    effect, i = F.lit(0.0), 0
    for period, order in ((7.0, WEEKLY), (365.25, YEARLY)):
        for k in range(1, order + 1):
            angle = days * F.lit(2 * math.pi * k / period)
            effect = effect + F.get("effects", F.lit(i)) * F.sin(angle) + F.get("effects", F.lit(i + 1)) * F.cos(angle)
            i += 2
    for j, r in enumerate(regressors):
        x = F.coalesce(F.col(r).cast("double"), F.lit(0.0))
        effect = effect + F.get("effects", F.lit(i + j)) * (x - F.get("means", F.lit(j))) / F.get("deviations", F.lit(j))
    return F.greatest(F.lit(0.0), F.col("scale") * F.when(F.col("multiplicative"), trend * (1 + effect)).otherwise(trend + effect))


def predict_series(coefficients: DataFrame, rows: DataFrame, regressors: Sequence[str] = SERIES_REGRESSORS,
                   keys: Sequence[str] = tuple(KEYS)) -> DataFrame:
    """``rows`` of the series that have coefficients, with ``prediction`` (not below 0) and ``n_train``."""
    regs = [r for r in regressors if r in rows.columns]
    names = [c.split(" ")[0] for c in COEFFICIENTS.split(", ") if c.split(" ")[0] not in KEYS]
    joined = rows.join(coefficients.drop(*[k for k in KEYS if k not in keys]), list(keys))
    return joined.withColumn("prediction", _value(regs)).drop(*[n for n in names if n != "n_train"])


def forecast(split: DataFrame, params: dict | None = None, regressors: Sequence[str] = SERIES_REGRESSORS,
             min_rows: int = C.MIN_SERIES_HISTORY) -> DataFrame:
    """Fitted on the training rows, predictions for every row of every fitted series."""
    coefficients = fit_series(split.filter(F.col("split") == "train"), params, regressors, min_rows)
    return predict_series(coefficients, split, regressors).select(
        *KEYS, "as_of_date", "split", F.col("y").cast("double").alias("y"), "prediction", "n_train")


def trial_errors(rows: DataFrame, trials: list[tuple[int, dict]], regressors: Sequence[str] = SERIES_REGRESSORS,
                 min_rows: int = C.MIN_SERIES_HISTORY) -> dict[int, float | None]:
    """MAE on ``role == 'val'`` of each trial fitted on ``role == 'train'``, over all series at once.

    Training rows are exploded over the trials (a search's batch, so a bounded number) and fitted in one
    ``applyInPandas`` by (series, trial).
    """
    regs = [r for r in regressors if r in rows.columns]
    params = dict(trials)
    copies = F.explode(F.lit([n for n, _ in trials])).alias("trial")
    keys = ["trial", *KEYS]
    schema = "trial int, " + COEFFICIENTS
    train = rows.filter((F.col("role") == "train") & F.col("y").isNotNull()).select(*KEYS, "as_of_date", "y", *regs, copies)
    fitted = train.groupBy(*keys).applyInPandas(
        lambda pdf: _fit_group(pdf, params[int(pdf["trial"].iloc[0])], regs, min_rows, keys), schema)
    got = predict_series(fitted, rows.filter(F.col("role") == "val"), regressors, keys=tuple(KEYS))
    errors = got.groupBy("trial").agg(F.avg(F.abs(F.col("y") - F.col("prediction"))).alias("mae"))
    out: dict[int, float | None] = dict.fromkeys(params)
    return out | {r["trial"]: r["mae"] for r in errors.collect()}

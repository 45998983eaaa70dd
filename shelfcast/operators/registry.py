"""Model registry decisions as table rewrites.

The registry is three small control tables: ``metrics(model, split, mae,
rmse, mape, r2)``, ``versions(model, version, stage, test_mae)`` and
``trials(model, trial, state, mae, params map<string,double>)``.  Every
decision is a DataFrame expression over them (no driver loop), so a registry
with many models is decided in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast import config as C
from shelfcast.functions.joins import attach_row


def select_model(metrics: DataFrame, preference: Sequence[str], split: str = "test") -> DataFrame:
    """Lowest MAE on ``split`` wins; ties go to the earlier model in ``preference``.

    One row: winner, its MAE, the runner-up and the improvement (%) of the
    winner over the runner-up (null with a single valid model).
    """
    pref = F.array_position(F.array(*[F.lit(p) for p in preference]), F.col("model"))
    m = metrics.filter((F.col("split") == split) & F.col("mae").isNotNull()) \
               .select("model", "mae", F.when(pref > 0, pref).otherwise(F.lit(len(preference) + 1)).alias("_p"))
    ranked = m.agg(F.sort_array(F.collect_list(F.struct("mae", "_p", "model"))).alias("_r"))
    w, r = F.element_at("_r", 1), F.element_at("_r", 2)
    return ranked.select(
        w["model"].alias("winner"), w["mae"].alias("winner_mae"),
        r["model"].alias("runner_up"), r["mae"].alias("runner_up_mae"),
        F.when(r["mae"] > 0, (r["mae"] - w["mae"]) / r["mae"] * F.lit(100.0)).alias("improvement_percent"))


def promote(versions: DataFrame, candidates: DataFrame, min_gain: float = C.PROMOTION_MIN_GAIN) -> DataFrame:
    """Per model, promote the candidate version if there is no Production
    version, its MAE is missing, or (current - new) / current >= ``min_gain``;
    then the old Production version is Archived.  Otherwise the candidate is
    Archived.  Returns the rewritten versions table (candidates included)."""
    cur = versions.filter(F.col("stage") == "Production").groupBy("model").agg(
        F.max_by("test_mae", "version").alias("_cur_mae"), F.max("version").alias("_cur_version"))
    dec = candidates.select("model", F.col("version").alias("_new_version"), F.col("test_mae").alias("_new_mae")) \
                    .join(cur, "model", "left")
    gain = (F.col("_cur_mae") - F.col("_new_mae")) / F.col("_cur_mae")
    promote_it = F.col("_cur_version").isNull() | F.col("_cur_mae").isNull() | (gain >= F.lit(min_gain))
    dec = dec.withColumn("_promote", F.coalesce(promote_it, F.lit(False)))
    new_rows = dec.select("model", F.col("_new_version").alias("version"),
                          F.when(F.col("_promote"), "Production").otherwise("Archived").alias("stage"),
                          F.col("_new_mae").alias("test_mae"))
    old = versions.join(dec.select("model", "_promote"), "model", "left").select(
        "model", "version",
        F.when(F.coalesce("_promote", F.lit(False)) & (F.col("stage") == "Production"), "Archived")
         .otherwise(F.col("stage")).alias("stage"), "test_mae")
    return old.unionByName(new_rows)


def rollback(versions: DataFrame, model: str, target_version: int | None = None) -> DataFrame:
    """Swap the Production version of ``model`` with the newest Archived one
    (or ``target_version``).  No target, or target == current -> unchanged
    table plus ``rolled_back = false``."""
    mv = versions.filter(F.col("model") == model)
    cur = mv.filter(F.col("stage") == "Production").agg(F.max("version").alias("_cur"))
    if target_version is None:
        tgt = mv.filter(F.col("stage") == "Archived").agg(F.max("version").alias("_tgt"))
    else:
        tgt = mv.filter(F.col("version") == target_version).agg(F.max("version").alias("_tgt"))
    d = attach_row(cur, tgt)  # two one-row aggregates: one row
    ok = F.col("_cur").isNotNull() & F.col("_tgt").isNotNull() & (F.col("_cur") != F.col("_tgt"))
    d = d.select("_cur", "_tgt", F.coalesce(ok, F.lit(False)).alias("_rb"))
    j = attach_row(versions, d)
    rolled = (F.col("model") == F.lit(model)) & F.col("_rb")
    stage = (F.when(rolled & (F.col("version") == F.col("_cur")), "Archived")
              .when(rolled & (F.col("version") == F.col("_tgt")), "Production")
              .otherwise(F.col("stage")))
    return j.select("model", "version", stage.alias("stage"), "test_mae", rolled.alias("rolled_back"))


def model_comparison(metrics: DataFrame, split: str = "test") -> DataFrame:
    """MAE / RMSE / R2 per model side by side (one row per metric)."""
    m = metrics.filter(F.col("split") == split)
    long = m.select("model", F.explode(F.array(
        *[F.struct(F.lit(k).alias("metric"), F.col(k).cast("double").alias("value"))
          for k in ("mae", "rmse", "r2")])).alias("e")).select("model", "e.*")
    return long.groupBy("metric").pivot("model").agg(F.first("value"))


def param_sensitivity(trials: DataFrame) -> DataFrame:
    """Correlation of each numeric parameter with the objective over completed trials."""
    t = trials.filter(F.col("state") == "COMPLETE").select(
        "model", "mae", F.explode("params").alias("param", "value"))
    return t.groupBy("model", "param").agg(F.corr("value", "mae").alias("corr_with_mae"),
                                          F.count(F.lit(1)).alias("n_trials"))


def top_trials(trials: DataFrame, n: int = 5) -> DataFrame:
    """The n best completed trials per model by MAE."""
    w = Window.partitionBy("model").orderBy(F.col("mae").asc(), F.col("trial").asc())
    return (trials.filter(F.col("state") == "COMPLETE")
                  .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n))

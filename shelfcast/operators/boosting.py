"""Boosted trees with patience and learnt sides for missing values (M06), and their node table (for M12).

* **Patience.**  Spark's own early stopping ends at the first round that gains less
  than a tolerance.  Here rounds are grown until the validation error has not
  improved for ``patience`` rounds: an ensemble of ``start`` rounds is fitted and every
  prefix of it evaluated in one pass (``evaluateEachIteration``); while the best
  prefix is too near the end, the number of rounds doubles.  Rounds are seeded, so a
  longer ensemble begins with the shorter one, and all fits together cost at most
  about four times the rounds that are needed.  The ensemble is then cut at its best round.
* **Missing values.**  A feature with nulls in the training rows gets an indicator
  feature next to it, and the training mean in place of its nulls, so trees can send
  missing rows to a side of their own.  Both are an ``SQLTransformer``, saved and
  loaded with the model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PATIENCE = 30
MISSING = "__missing"


def best_round(errors: Sequence[float], patience: int = PATIENCE) -> tuple[int, bool]:
    """(rounds of the best prefix, whether ``patience`` rounds without a better one followed it)."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def cut_ensemble(spark: SparkSession, model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The model of the first ``rounds`` trees."""
    if rounds >= model.getNumTrees:
        return model
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(jvm.double, rounds)
    for i, (tree, weight) in enumerate(zip(model._java_obj.trees()[:rounds], model.treeWeights[:rounds], strict=True)):
        trees[i], weights[i] = tree, float(weight)
    java = jvm.org.apache.spark.ml.regression.GBTRegressionModel(model.uid, trees, weights, model.numFeatures)
    out = GBTRegressionModel(java)
    out._resetUid(model.uid)
    return out.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(model.getPredictionCol())


def fit_with_patience(gbt: GBTRegressor, train: DataFrame, val: DataFrame, patience: int = PATIENCE, start: int = 100,
                      metric: str = "absolute") -> tuple[GBTRegressionModel, list[float]]:
    """Model cut at its best round on ``val`` and the error after each round that was grown.

    ``gbt``'s ``maxIter`` is the most rounds there can be.
    """
    most = gbt.getMaxIter()
    rounds = min(most, start)
    while True:
        model = gbt.copy({gbt.maxIter: rounds}).fit(train)
        errors = model.evaluateEachIteration(val, metric)
        best, settled = best_round(errors, patience)
        if settled or rounds == most:
            return cut_ensemble(train.sparkSession, model, best), errors
        rounds = min(most, 2 * rounds)


def missing_sides(train: DataFrame, features: Sequence[str]) -> tuple[SQLTransformer, list[str]]:
    """Stage that fills nulls and marks them, and the names of all features behind it.

    Features without a null in ``train`` get no indicator; a null met only when scoring takes the mean.
    """
    stats = train.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(features)],
                      *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(features)]).first()
    gaps = [c for i, c in enumerate(features) if stats[f"n{i}"]]
    fills = [f"coalesce(CAST(`{c}` AS DOUBLE), {stats[f'm{i}'] or 0.0!r}D) AS `{c}`" for i, c in enumerate(features)]
    marks = [f"CAST(`{c}` IS NULL AS DOUBLE) AS `{c}{MISSING}`" for c in gaps]
    names = ", ".join(f"`{c}`" for c in features)
    stage = SQLTransformer(statement=f"SELECT * EXCEPT ({names}), {', '.join(fills + marks)} FROM __THIS__")
    return stage, [*features, *[c + MISSING for c in gaps]]


def node_table(spark: SparkSession, model: GBTRegressionModel, path: str) -> DataFrame:
    """Nodes of all trees: tree, weight, node, prediction, cover, left, right, feature, threshold, categories.

    Read from the model's saved form under ``path`` (written here).  ``left`` and ``right`` are -1 in a
    leaf; ``cover`` is the weighted number of training rows that reached the node.  A row goes left if its
    feature is at most ``threshold``.
    """
    model.write().overwrite().save(path)
    n, weights = F.col("nodeData"), [float(w) for w in model.treeWeights]
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.get(F.lit(weights), F.col("treeID")).alias("weight"), n["id"].alias("node"),
        n["prediction"].alias("prediction"),
        F.get(n["impurityStats"], F.lit(0)).alias("cover"), n["leftChild"].alias("left"),
        n["rightChild"].alias("right"), n["split"]["featureIndex"].alias("feature"),
        F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        n["split"]["numCategories"].alias("categories"))

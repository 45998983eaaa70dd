"""Tree attribution (M12): path-dependent Shapley values of a fitted ensemble.

For a row and a leaf, the features on the leaf's path form a small game: a feature
that is known lets the row through (1) or not (0), one that is unknown lets the
share of training rows through that went that way.  The Shapley values of this
product of factors have a closed form over the subset sizes, kept as a polynomial
(:func:`size_weights`), so a leaf costs the square of its path's length, not all subsets.
Values of leaves and trees add up (tree weights multiply), and for each row all
features' values add up to its prediction minus the mean prediction.

The node table (bounded by rounds and depth) is broadcast; rows are explained in
Arrow batches, all rows of a batch at once per leaf.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.operators.boosting import node_table
from shelfcast.session import scratch_path

MAX_NODES = 2_000_000  # bound of the broadcast: rounds x nodes of a tree


class Leaf(NamedTuple):
    value: float                                   # prediction times the tree's weight
    features: tuple[int, ...]                      # distinct features on the path
    shares: np.ndarray                             # rows that go the leaf's way at the splits on each, multiplied
    ranges: tuple[tuple[float, float], ...]        # the row goes that way if low < x <= high


def leaves(nodes: Sequence) -> list[Leaf]:
    """Leaves of all trees from rows of the node table."""
    trees: dict[int, dict[int, tuple]] = {}
    for r in nodes:
        if r["categories"] is not None and r["categories"] >= 0 and r["left"] >= 0:
            raise ValueError("splits on categories are not supported: give the trees numbers")
        trees.setdefault(r["tree"], {})[r["node"]] = r
    out = []
    for tree in trees.values():
        todo = [(0, {})]
        while todo:
            at, path = todo.pop()
            r = tree[at]
            if r["left"] < 0:
                names = tuple(path)
                out.append(Leaf(r["prediction"] * r["weight"], names, np.array([path[f][0] for f in names]),
                                tuple(path[f][1:] for f in names)))
                continue
            f, t = r["feature"], r["threshold"]
            share, low, high = path.get(f, (1.0, -np.inf, np.inf))
            for child, bounds in ((r["left"], (low, min(high, t))), (r["right"], (max(low, t), high))):
                part = tree[child]["cover"] / r["cover"]
                todo.append((child, path | {f: (share * part, *bounds)}))
    return out


def size_weights(n: int) -> np.ndarray:
    """Weight of a subset of k of the n - 1 other features: k! (n - 1 - k)! / n!."""
    out = np.ones(n)
    out[0] = 1 / n
    for k in range(1, n):
        out[k] = out[k - 1] * k / (n - k)
    return out


def shapley(x: np.ndarray, of: list[Leaf], n_features: int) -> tuple[np.ndarray, float]:
    """Values (rows x features) of the rows of ``x`` and the mean prediction."""
    out, mean = np.zeros((len(x), n_features)), 0.0
    for leaf in of:
        mean += leaf.value * float(np.prod(leaf.shares))
        n = len(leaf.features)
        if not n:
            continue
        passes = np.stack([(x[:, f] > low) & (x[:, f] <= high) for f, (low, high) in zip(leaf.features, leaf.ranges)]).astype(float)
        weights = size_weights(n)
        for i, f in enumerate(leaf.features):
            # coefficient k: sum over the subsets of k other features of the products of their factors
            poly = np.zeros((n, len(x)))
            poly[0] = 1.0
            for j in range(n):
                if j != i:
                    poly[1:] = poly[1:] * leaf.shares[j] + poly[:-1] * passes[j]
                    poly[0] *= leaf.shares[j]
            out[:, f] += leaf.value * (passes[i] - leaf.shares[i]) * (weights @ poly)
    return out, mean


def explain(model: PipelineModel, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` as keys, feature, value (its share in the prediction) and base (the mean prediction)."""
    gbt: GBTRegressionModel = model.stages[-1]
    names = list(model.stages[-2].getInputCols())
    spark = rows.sparkSession
    nodes = node_table(spark, gbt, scratch_path(spark, f"nodes-{gbt.uid}")).limit(MAX_NODES + 1).collect()
    if len(nodes) > MAX_NODES:
        raise ValueError(f"the ensemble has more than {MAX_NODES} nodes")
    table = spark.sparkContext.broadcast(leaves(nodes))
    vectors = PipelineModel(model.stages[:-1]).transform(rows).select(*keys, vector_to_array(gbt.getFeaturesCol()).alias("__x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(len(keys)).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            values, mean = shapley(x, table.value, len(names))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(names), pa.int32()), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keys)], lists, pa.array(np.full(len(x), mean))],
                                             [*keys, "values", "base"])

    schema = vectors.select(*keys).schema.add("values", T.ArrayType(T.DoubleType())).add("base", T.DoubleType())
    got = vectors.mapInArrow(run, schema)
    return got.select(*keys, "base", F.posexplode("values").alias("__i", "value")).select(
        *keys, F.get(F.lit(names), F.col("__i")).alias("feature"), "value", "base")


def attribution_sample(rows: DataFrame, keys: Sequence[str], n: int = 500, seed: int = 42) -> DataFrame:
    """The ``n`` rows with the smallest seeded hash of their keys (all rows, if there are fewer)."""
    h = F.xxhash64(F.lit(seed), *keys)
    return rows.withColumn("__h", h).orderBy("__h", *keys).limit(n).drop("__h")


def mean_attribution(values: DataFrame, top: int = 20) -> DataFrame:
    """Features by mean absolute value over the explained rows."""
    return values.groupBy("feature").agg(F.avg(F.abs("value")).alias("mean_abs_value")) \
        .orderBy(F.desc("mean_abs_value"), "feature").limit(top)

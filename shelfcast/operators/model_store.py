"""Stored models by name and version, and scoring from them (M13, with M09-M11).

``<root>/<model>/v=<version>/`` holds a fitted ``PipelineModel`` and a one-row
``meta`` table (features, horizon, code maps).  The pipeline's stages are all that
lies between the feature table and a prediction:

1. :class:`SeriesCodeModel`: the code of each series the training rows know (-1 for others), kept as a table;
2. an ``SQLTransformer`` that scales by the training means and deviations;
3. an ``SQLTransformer`` that fills and marks missing values (``boosting.missing_sides``);
4. ``VectorAssembler`` and the trees.

Rows to score come from ``features_v2(rows="latest")``, the transform that made the
training rows, with the code maps stored beside the model.  So a row means the same when it is
learnt from and when it is scored.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast import config as C
from shelfcast.functions.joins import bounded_broadcast
from shelfcast.operators import boosting as BO
from shelfcast.operators import forecast as FC
from shelfcast.operators.splits import dense_index, scaler_stats


class SeriesCode(Estimator, HasInputCol, HasOutputCol):
    """W13 as a pipeline stage: codes by sorted id of the rows it is fitted on."""

    def __init__(self, inputCol: str = "series_id", outputCol: str = "series_enc"):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _fit(self, dataset: DataFrame) -> SeriesCodeModel:
        codes = dense_index(dataset, self.getInputCol(), self.getOutputCol())
        return SeriesCodeModel(codes)._set(inputCol=self.getInputCol(), outputCol=self.getOutputCol())


class SeriesCodeModel(Model, HasInputCol, HasOutputCol, MLWritable, MLReadable):
    """The code of a series by join; a series the table lacks gets -1."""

    def __init__(self, codes: DataFrame | None = None):
        super().__init__()
        self.codes = codes

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = self.getOutputCol()
        joined = dataset.drop(out).join(bounded_broadcast(self.codes), self.getInputCol(), "left")
        return joined.withColumn(out, F.coalesce(F.col(out), F.lit(-1)))

    def write(self) -> MLWriter:
        return _SeriesCodeWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _SeriesCodeReader(cls)


class _SeriesCodeWriter(MLWriter):
    def __init__(self, instance: SeriesCodeModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.codes.write.parquet(os.path.join(path, "codes"))


class _SeriesCodeReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> SeriesCodeModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        out = self.cls(self.sparkSession.read.parquet(os.path.join(path, "codes")))
        out._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(out, metadata)
        return out


def scaler_stage(train: DataFrame, columns: Sequence[str] = C.SCALED_COLUMNS) -> SQLTransformer:
    """M04 as a stage: (x - mean) / deviation with the training rows' statistics."""
    stats = {r["column"]: r for r in scaler_stats(train, columns).collect()}  # one row per scaled column
    known = [c for c in columns if c in stats and stats[c]["std"] is not None]
    scaled = [f"(CAST(`{c}` AS DOUBLE) - {stats[c]['mean']!r}D) / {stats[c]['std']!r}D AS `{c}`" for c in known]
    names = ", ".join(f"`{c}`" for c in known)
    return SQLTransformer(statement=f"SELECT * EXCEPT ({names}), {', '.join(scaled)} FROM __THIS__" if known
                          else "SELECT * FROM __THIS__")


def fit_pipeline(train: DataFrame, val: DataFrame, features: Sequence[str] = C.TRAIN_FEATURES, params: dict | None = None,
                 weight: str = "sample_weight", patience: int = BO.PATIENCE, start: int = 100) -> PipelineModel:
    """All stages fitted on the training rows; the validation rows choose the number of rounds."""
    code = SeriesCode().fit(train)
    raw = [f for f in features if f in train.columns or f == "series_enc"]
    coded = code.transform(train)
    scaler = scaler_stage(coded)
    scaled = scaler.transform(coded)
    sides, names = BO.missing_sides(scaled, raw)
    # inputs of the vector stage keep their null semantics: nulls are filled by the stage before
    vector = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="error")
    p = {k: v for k, v in dict(FC.GBT_DEFAULTS, **(params or {})).items() if k != "validationTol"}
    gbt = GBTRegressor(featuresCol="features", labelCol="y", predictionCol="raw_prediction", lossType="squared", **p)
    if weight in train.columns:
        gbt.setWeightCol(weight)
    before = PipelineModel([code, scaler, sides, vector])
    keep = ["y", "features", *([weight] if weight in train.columns else [])]
    label = F.col("y").cast("double")
    tr, va = (before.transform(d).withColumn("y", label).select(*keep).cache() for d in (train, val))
    try:
        model, _ = BO.fit_with_patience(gbt, tr, va, patience, start)
    finally:
        tr.unpersist()
        va.unpersist()
    return PipelineModel([*before.stages, model])


def score(pipeline: PipelineModel, rows: DataFrame) -> DataFrame:
    """M13 + F30: ``rows`` plus ``prediction`` (not below 0) and ``predicted_demand`` (rounded)."""
    out = pipeline.transform(rows)
    return out.withColumn("prediction", F.greatest(F.col("raw_prediction"), F.lit(0.0))) \
        .withColumn("predicted_demand", FC.predicted_demand("prediction")).drop("features", "raw_prediction")


class Stored(NamedTuple):
    pipeline: PipelineModel
    meta: dict


def version_path(root: str, model: str, version: int) -> str:
    return os.path.join(root, model, f"v={version}")


def save(spark: SparkSession, pipeline: PipelineModel, root: str, model: str, version: int, horizon: int = 1, **meta) -> str:
    """Write a version (again, if it is there); the meta table comes last and marks it complete."""
    path = version_path(root, model, version)
    pipeline.write().overwrite().save(os.path.join(path, "pipeline"))
    kept = {"model": model, "version": version, "horizon": horizon,
            "code_maps": {"category_order": C.CATEGORY_ORDER, "region_codes": C.REGION_CODES, "season_codes": C.SEASON_CODES}, **meta}
    spark.createDataFrame([(json.dumps(kept),)], "meta string").coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "meta"))
    return path


def load(spark: SparkSession, root: str, model: str, version: int) -> Stored:
    path = version_path(root, model, version)
    meta = json.loads(spark.read.parquet(os.path.join(path, "meta")).first()["meta"])
    return Stored(PipelineModel.load(os.path.join(path, "pipeline")), meta)


def production_version(versions: DataFrame, model: str) -> int:
    """The version of ``model`` in Production (M10, M11 decide which)."""
    row = versions.filter((F.col("model") == model) & (F.col("stage") == "Production")).agg(F.max("version").alias("v")).first()
    if row["v"] is None:
        raise ValueError(f"no version of {model} is in Production")
    return row["v"]


def load_production(spark: SparkSession, root: str, versions: DataFrame, model: str) -> Stored:
    return load(spark, root, model, production_version(versions, model))

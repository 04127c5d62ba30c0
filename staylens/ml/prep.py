"""Vector features: index, one-hot encode, scale, assemble."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.schemas import CATEGORICAL, FLAGS, NUMERIC, TARGET
from staylens.session import kept

SCALED = "scaled_numeric_features"


@dataclass(frozen=True)
class Columns:
    """Roles of the model columns."""

    categorical: Sequence[str] = field(default_factory=lambda: list(CATEGORICAL))
    numeric: Sequence[str] = field(default_factory=lambda: list(NUMERIC))
    flags: Sequence[str] = field(default_factory=lambda: list(FLAGS))
    target: str = TARGET


def build(columns: Columns = Columns()) -> Pipeline:
    """The pipeline. All categories are indexed by one stage, so one job counts them all.

    A category not seen in training keeps its row and encodes as all zeros.
    """
    indexed = [f"{c}_idx" for c in columns.categorical]
    encoded = [f"{c}_vec" for c in columns.categorical]
    stages = []
    if columns.categorical:
        stages += [
            StringIndexer(inputCols=list(columns.categorical), outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded),
        ]
    stages += [
        VectorAssembler(inputCols=list(columns.numeric), outputCol="numeric_features_vec"),
        StandardScaler(inputCol="numeric_features_vec", outputCol=SCALED, withMean=True, withStd=True),
        VectorAssembler(inputCols=[*encoded, SCALED, *columns.flags], outputCol="features"),
    ]
    return Pipeline(stages=stages)


def fit(train: DataFrame, columns: Columns = Columns()) -> PipelineModel:
    """Fit on training rows only; the passes of the fit share one computation of them.

    The model holds one name per category, as a linear model holds one weight per category:
    both grow with the categories and not with the rows.
    """
    with kept(train) as rows:
        return build(columns).fit(rows)


def transform(model: PipelineModel, df: DataFrame, columns: Columns = Columns()) -> DataFrame:
    """Rows -> (features, label)."""
    return model.transform(df).select("features", F.col(columns.target).cast("double").alias("label"))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_mapping(vectors: DataFrame, columns: Columns = Columns()) -> DataFrame:
    """(feature_index, feature_name), read from the vector column's metadata.

    The scaler drops the names of its inputs; they are put back by position.
    """
    attributes = vectors.schema["features"].metadata["ml_attr"]["attrs"]
    rows = sorted((a["idx"], a["name"]) for kind in attributes.values() for a in kind)
    mapping = vectors.sparkSession.createDataFrame(rows, "feature_index int, feature_name string")
    position = F.regexp_extract("feature_name", rf"^{SCALED}_(\d+)$", 1)
    names = F.array(*[F.lit(c) for c in columns.numeric])
    real = F.get(names, position.try_cast("int"))
    return mapping.withColumn("feature_name", F.coalesce(real, "feature_name"))


def category_index(model: PipelineModel, spark) -> DataFrame:
    """(column, category, position) of the fitted index tables."""
    indexer = model.stages[0]
    rows = [
        (column, label, position)
        for column, labels in zip(indexer.getInputCols(), indexer.labelsArray)
        for position, label in enumerate(labels)
    ]
    return spark.createDataFrame(rows, "column string, category string, position bigint")


def scaling(model: PipelineModel, spark, columns: Columns = Columns()) -> DataFrame:
    """(column, mean, stddev) of the fitted scaler."""
    scaler = model.stages[-2]
    rows = [(c, float(m), float(s)) for c, m, s in zip(columns.numeric, scaler.mean, scaler.std)]
    return spark.createDataFrame(rows, "column string, mean double, stddev double")

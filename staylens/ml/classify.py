"""Three classifiers, their tuning grids, saving and loading."""

from __future__ import annotations

from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.session import dealt, enable_checkpoints, kept, side_by_side

NAMES = {"lr": "Logistic Regression", "rf": "Random Forest", "gbt": "GBTClassifier"}

_CLASSES = {"lr": LogisticRegression, "rf": RandomForestClassifier, "gbt": GBTClassifier}

# Settings of the plain fits.
PARAMS = {
    "lr": {"maxIter": 100, "regParam": 0.0, "elasticNetParam": 0.0},
    "rf": {"numTrees": 100, "maxDepth": 10, "seed": 42},
    "gbt": {"maxIter": 100, "maxDepth": 5, "seed": 42},
}
# Settings tried by tuning.
GRIDS = {
    "lr": {"regParam": [0.0, 0.01, 0.1], "elasticNetParam": [0.0, 0.5, 1.0]},
    "rf": {"numTrees": [50, 100], "maxDepth": [5, 10], "maxBins": [32, 64]},
    "gbt": {"maxDepth": [5, 10], "maxIter": [20, 50]},
}


def estimator(kind: str, **params):
    """Classifier on (features, label) with the usual settings, overridden by ``params``."""
    settings = {**PARAMS[kind], **params}
    return _CLASSES[kind](featuresCol="features", labelCol="label", **settings)


def fit(kind: str, train: DataFrame, **params):
    """Fit one classifier. The fit passes over its input many times, so it is kept."""
    enable_checkpoints(train.sparkSession)
    with kept(dealt(train)) as rows:
        return estimator(kind, **params).fit(rows)


def every_kind(work, train: DataFrame) -> dict:
    """``work(kind, rows)`` by kind, side by side on one set of kept rows: a fit of boosted trees is a chain of small
    stages, and a forest's tasks fill the cores it leaves idle."""
    enable_checkpoints(train.sparkSession)
    with kept(dealt(train)) as rows:
        return dict(zip(NAMES, side_by_side(lambda kind: work(kind, rows), NAMES, train.sparkSession, len(NAMES))))


def validation_scores(base, maps: list, rows: DataFrame, parallelism: int, seed: int) -> list[float]:
    """ROC-AUC of every setting on the rows that Spark's ``TrainValidationSplit`` holds back, which always ends in one more fit of all rows."""
    evaluator = BinaryClassificationEvaluator(metricName="areaUnderROC")
    drawn = rows.withColumn("_drawn", F.rand(seed))
    with kept(drawn.filter(F.col("_drawn") < 0.8)) as train, kept(drawn.filter(F.col("_drawn") >= 0.8)) as held:
        return side_by_side(lambda m: evaluator.evaluate(base.fit(train, m).transform(held)), maps, rows.sparkSession, parallelism)


def tune(
    kind: str, train: DataFrame, grid: dict | None = None, parallelism: int = 4, seed: int = 42, refit: bool = True, **params
):
    """Try a grid on an 80/20 validation split; returns (best model, report).

    The report has one row per grid point: its settings as text, its ROC-AUC, and whether
    it won. Rows are kept on executors for all fits; ``seed`` fixes the validation rows.
    The best model is fitted on all rows, for the report alone (``refit=False``) it is not and None is returned.
    """
    spark = train.sparkSession
    enable_checkpoints(spark)
    base = estimator(kind, **params)
    builder = ParamGridBuilder()
    for name, values in (grid or GRIDS[kind]).items():
        builder = builder.addGrid(base.getParam(name), values)
    maps = builder.build()
    with kept(dealt(train)) as rows:
        scores = validation_scores(base, maps, rows, parallelism, seed)
        winner = max(range(len(scores)), key=scores.__getitem__)
        model = base.fit(rows, maps[winner]) if refit else None
    tried = [
        (NAMES[kind], ", ".join(f"{p.name}={v}" for p, v in m.items()), float(s), i == winner)
        for i, (m, s) in enumerate(zip(maps, scores))
    ]
    report = spark.createDataFrame(tried, "model string, settings string, roc_auc double, best boolean")
    return model, report


def best_settings(kind: str, model) -> dict:
    """Values of the tuned settings in a fitted model."""
    return {name: model.getOrDefault(name) for name in GRIDS[kind]}


def save(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_gbt(path: str) -> GBTClassificationModel:
    return GBTClassificationModel.load(path)

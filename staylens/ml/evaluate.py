"""Evaluation from grouped counts: predictions never leave the cluster row by row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.session import settled

#: Parts into which scores are cut for running sums.
STEPS = 10_000


def scored(predictions: DataFrame) -> DataFrame:
    """(label, prediction, score, raw): score is the probability of class 1, raw its margin.

    A probability rounds to 1 long before margins stop differing, so ranking uses ``raw``.
    """
    return predictions.select(
        F.col("label").cast("double").alias("label"),
        F.col("prediction").cast("double").alias("prediction"),
        vector_to_array("probability")[1].alias("score"),
        vector_to_array("rawPrediction")[1].alias("raw"),
    )


def confusion_counts(predictions: DataFrame) -> DataFrame:
    """Rows per (label, prediction), both taken from the same row."""
    return predictions.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("count"))


def confusion_matrix(predictions: DataFrame, classes: Sequence[float] = (0.0, 1.0)) -> DataFrame:
    """One row per true class, one column per predicted class."""
    cells = [
        F.coalesce(F.sum(F.when(F.col("prediction") == c, F.col("count"))), F.lit(0)).alias(f"predicted_{int(c)}")
        for c in classes
    ]
    return confusion_counts(predictions).groupBy("label").agg(*cells).orderBy("label")


def metrics(predictions: DataFrame) -> DataFrame:
    """Accuracy and the label-weighted precision, recall and F1, from the confusion counts.

    Classes are weighted by their true frequency; a class never predicted has precision 0.
    """
    counts = confusion_counts(predictions)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0)
    # One row per class: as truth and as prediction.
    sides = counts.select(
        F.inline(
            F.array(
                F.struct(F.col("label").alias("class"), F.col("count").alias("actual"), F.lit(0).cast("bigint").alias("predicted"), hit.alias("hits")),
                F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("actual"), F.col("count").alias("predicted"), F.lit(0).cast("bigint").alias("hits")),
            )
        )
    )
    classes = sides.groupBy("class").agg(
        F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits")
    )
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide(F.col("hits"), F.col("predicted")), zero)
    recall = F.coalesce(F.try_divide(F.col("hits"), F.col("actual")), zero)
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), zero)
    weight = F.col("actual")

    def weighted(value: Column) -> Column:
        return F.try_divide(F.sum(value * weight), F.sum(weight))

    return classes.agg(
        F.try_divide(F.sum("hits"), F.sum("actual")).alias("accuracy"),
        weighted(precision).alias("weighted_precision"),
        weighted(recall).alias("weighted_recall"),
        weighted(f1).alias("f1"),
    )


def _curve(predictions: DataFrame) -> DataFrame:
    """``(score, positives, negatives, tp, fp)``: one row a distinct score, with counts at or above it.

    Rows are counted per score first, so a score that many rows share is one row. The running
    sums are exact at any size: steps of the score are summed and put in order (``STEPS`` rows
    in one window), and within a step the sums run on their own.
    """
    counted = predictions.groupBy("score").agg(
        F.count_if(F.col("label") == 1).alias("positives"), F.count_if(F.col("label") == 0).alias("negatives")
    )
    # Only a way to part the work: equal scores share a step and a larger score never has a smaller one.
    step = F.least(F.greatest(F.floor(F.col("score") * STEPS), F.lit(0)), F.lit(STEPS - 1)).cast("int")
    rows = settled(counted.withColumn("step", step), "scores")
    above = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)
    steps = rows.groupBy("step").agg(F.sum("positives").alias("p"), F.sum("negatives").alias("n"))
    steps = steps.select("step", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("p", "n")])
    inside = Window.partitionBy("step").orderBy(F.desc("score"))
    return rows.join(steps, "step").select(
        "score", "positives", "negatives",
        (F.col("p_above") + F.sum("positives").over(inside)).alias("tp"),
        (F.col("n_above") + F.sum("negatives").over(inside)).alias("fp"),
    )


def roc_points(predictions: DataFrame) -> DataFrame:
    """Every point of the ROC curve: the start (0, 0) without a threshold, then one a distinct score."""
    curve = _curve(predictions)
    whole = curve.agg(F.sum("positives").alias("p"), F.sum("negatives").alias("n")).first()
    p, n = whole["p"] or 0, whole["n"] or 0
    points = curve.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("fp").cast("double"), F.lit(float(n))).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.lit(float(p))).alias("tpr"),
    )
    start = predictions.sparkSession.createDataFrame([(None, 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return start.unionByName(points)


def roc_auc(predictions: DataFrame) -> DataFrame:
    """Exact area under the curve as one row: by trapezoids, in whole numbers until the last step."""
    curve = _curve(predictions)
    # Twice the area of a score's trapezoid, its width in negatives and its heights in positives.
    twice = F.col("negatives").cast("decimal(38,0)") * (2 * F.col("tp") - F.col("positives"))
    sums = curve.agg(F.sum(twice).alias("a"), F.sum("positives").alias("p"), F.sum("negatives").alias("n"))
    pairs = 2 * F.col("p").cast("double") * F.col("n").cast("double")
    return sums.select(F.try_divide(F.col("a").cast("double"), pairs).alias("roc_auc"))


def evaluate(predictions: DataFrame) -> DataFrame:
    """All five metrics as one row; the AUC comes from Spark's own sorted evaluation."""
    ranking = "raw" if "raw" in predictions.columns else "score"
    auc = BinaryClassificationEvaluator(rawPredictionCol=ranking, metricName="areaUnderROC").evaluate(predictions)
    return metrics(predictions).withColumn("roc_auc", F.lit(float(auc)))


def compare(models: Mapping[str, DataFrame], digits: int = 4) -> DataFrame:
    """One row of rounded metrics per named set of scored predictions."""
    parts = []
    for name, predictions in models.items():
        row = evaluate(predictions)
        parts.append(row.select(F.lit(name).alias("model"), *[F.round(c, digits).alias(c) for c in row.columns]))
    return reduce(DataFrame.unionByName, parts)


def feature_importance(model, mapping: DataFrame, n: int | None = 20) -> DataFrame:
    """Importance per named feature, largest first; ``n`` limits the report."""
    values = model.featureImportances.toArray()
    spark = mapping.sparkSession
    rows = [(i, float(v)) for i, v in enumerate(values)]
    importance = spark.createDataFrame(rows, "feature_index int, importance double")
    named = importance.join(mapping, "feature_index", "left").orderBy(F.desc("importance"), "feature_index")
    return named.limit(n) if n else named

"""Category positions as a table on the cluster, for columns with more categories than a driver should hold.

Positions are those of Spark's own indexer: by falling frequency, then by name. Rows get
theirs by a join, which Spark broadcasts while the table is small. Hashed features need no
table at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import FeatureHasher
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.operators.scan import running_totals
from staylens.session import settled

HASHED_FEATURES = 1 << 18


def category_positions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, category, n, position)``, written to the shared folder. Nulls are no category.

    All columns are counted in one pass. Positions are numbered over ranges, so a column with
    hundreds of millions of categories is numbered by many tasks.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category")) for c in columns]))
    values = df.select(pairs.alias("p")).select("p.*").filter(F.col("category").isNotNull())
    counts = values.groupBy("column", "category").agg(F.count(F.lit(1)).alias("n"))
    numbered = running_totals(counts, ["column"], ["-n", "category"], {"position": F.lit(1)})
    return settled(numbered.withColumn("position", F.col("position") - 1), "category-positions")


def with_positions(df: DataFrame, table: DataFrame, columns: Sequence[str], suffix: str = "_idx") -> DataFrame:
    """Add each column's position; a null or a category the table lacks gets the number of categories."""
    sizes = {r["column"]: r["n"] for r in table.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    for c in columns:
        side = table.filter(F.col("column") == c).select(F.col("category").alias("_category"), F.col("position").alias(f"{c}{suffix}"))
        joined = df.join(side, F.col(c).cast("string") == F.col("_category"), "left").drop("_category")
        df = joined.withColumn(f"{c}{suffix}", F.coalesce(f"{c}{suffix}", F.lit(sizes.get(c, 0)).cast("bigint")))
    return df


def hashed_features(df: DataFrame, columns: Sequence[str], output: str = "hashed", size: int = HASHED_FEATURES) -> DataFrame:
    """Categories as a sparse vector of hashed places; nothing is fitted or kept."""
    return FeatureHasher(inputCols=list(columns), outputCol=output, numFeatures=size, categoricalCols=list(columns)).transform(df)

"""Readers with explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from staylens.schemas import RAW


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Parquet table ``name``; filters and column choices reach the scan."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_bookings(
    spark: SparkSession, path: str, schema: StructType = RAW, mode: str = "FAILFAST"
) -> DataFrame:
    """CSV with a header row, tokens such as ``NULL`` kept as text.

    Columns are found by their name in the header, in whatever order the file has them; a
    missing one fails, and so do several files whose headers differ
    (:func:`staylens.sources.read_csv_folder` maps each file by its own). FAILFAST by default: a shifted row or a mistyped value must not turn
    into a null unseen.
    """
    rows = spark.read.csv(path, header=True, mode=mode, enforceSchema=False)
    missing = [f.name for f in schema.fields if f.name not in rows.columns]
    if missing:
        raise ValueError(f"no such columns in the header: {missing}")

    def typed(name: str, kind: DataType) -> Column:
        return F.col(name).cast(kind) if mode == "FAILFAST" else F.col(name).try_cast(kind)

    return rows.select(*[typed(f.name, f.dataType).alias(f.name) for f in schema.fields])


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Parquet hand-over between stages, which keeps types and vector metadata."""
    return spark.read.parquet(path)


def register(df: DataFrame, name: str = "hotel_bookings") -> DataFrame:
    """Make ``df`` readable from SQL text under ``name``."""
    df.createOrReplaceTempView(name)
    return df

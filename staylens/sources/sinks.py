"""Writers. Parquet is the default between stages; CSV is for exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    df.write.mode("overwrite").csv(path, header=True, compression=compression)


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    """Write ``df`` over the partitions it has rows for, and leave the others as they are.

    Running a period again replaces just that period.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, keys: tuple[str, ...], buckets: int) -> DataFrame:
    """``df`` as table ``name`` in buckets of ``keys``, sorted within: joins and groupings on them need no shuffle."""
    writer = df.repartition(buckets, *keys).write.mode("overwrite").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)

"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the results depend on; everything else is the cluster's.

    ANSI mode stays as it is. RocksDB keeps streaming state off the JVM heap, so
    its size is bounded by executor disk and not by executor memory. Generated methods
    above 8000 bytes are never compiled by the JVM and run about ten times slower (long
    rule filters get there), so such stages use the split form instead.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return spark


def shuffle_partitions(shuffle_bytes: int, cores: int, target_bytes: int = 128 << 20) -> int:
    """Partition count for ``shuffle_bytes``: about ``target_bytes`` each, two waves at least."""
    return max(2 * cores, -(-shuffle_bytes // target_bytes))


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster other
    machines could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not _is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="staylens-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/staylens/{label}-{uuid.uuid4().hex}"


def make_folder(spark: SparkSession, path: str) -> None:
    """Create ``path`` if it is not there, in whatever store it names."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hadoop)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """``key`` set for a while."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shuffles_dropped(spark: SparkSession):
    """Within, a query's shuffle files go when it ends, and not when the driver next collects its garbage.

    For tables that are written and then read back: a frame that is run again shuffles again.
    """
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def settled(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: for small results that are read twice."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows in a task of an iterative fit: what it keeps of a partition is then a small part of an executor's memory.
ROWS_PER_TASK = 250_000


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` in partitions of at most about ``ROWS_PER_TASK`` rows, dealt anew only where they are larger.

    Compact files are read in few large splits; as vectors these can be larger than the memory of a task.
    """
    parts = -(-(df.count() if rows is None else rows) // ROWS_PER_TASK)
    return df if parts <= df.rdd.getNumPartitions() else df.repartition(parts)


#: Rows a task of a fit has at least: the trees' fits run a thousand small stages, and a task has its price in each.
LEAST_ROWS_PER_TASK = 2_000

#: Tasks a core of rows that are dealt for one pass: long ones then even out.
WAVES = 3


def dealt(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly, one task a core: all tasks of a stage start and end together, however many files were read and
    whichever of their splits hold rows. Larger frames get tasks of ``ROWS_PER_TASK``, smaller ones fewer tasks. A frame its
    owner already keeps is left alone. Rows are in order within a task: what a fit draws goes by a row's place, and a shuffle
    delivers rows as they arrive.
    """
    if df.is_cached:
        return df
    rows, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(cores, rows // LEAST_ROWS_PER_TASK), -(-rows // ROWS_PER_TASK))
    return df.repartition(parts).sortWithinPartitions(*df.columns)


def dealt_by(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` (mostly different values) where one of its own tasks has more than twice a core's share of the rows.

    A row group is read by one task, however large it is, so heavy work on the rows of a compact file would be one task's.
    Dealt rows are shuffled whole, which pays only for heavy work (regular expressions over texts). Tasks are sized up by
    ``keys`` alone: of columnar files no other column is read for it.
    """
    sizes = df.select(*keys).groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("rows"))
    largest, rows = sizes.agg(F.max("rows"), F.sum("rows")).first()
    cores, most = df.sparkSession.sparkContext.defaultParallelism, (rows or 0) // LEAST_ROWS_PER_TASK
    if min(cores, most) < 2 or largest * min(cores, most) <= 2 * rows:
        return df
    return df.repartition(min(WAVES * cores, most), *keys)


def side_by_side(work: Callable, items: Iterable, spark: SparkSession, most: int) -> list:
    """``work`` of every item, at most ``most`` at a time; results in the items' order. For jobs that leave cores idle between stages."""
    with ThreadPool(most) as pool:
        return pool.map(inheritable_thread_target(spark)(work), items, chunksize=1)


def enable_checkpoints(spark: SparkSession) -> None:
    """Give iterative fits a reliable place to cut their lineage."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(spark, "lineage"))


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` on executors (memory, then disk) for work that reads it many times.

    Lost blocks are computed again. A frame its owner already keeps is left alone.
    """
    if df.is_cached:
        yield df
        return
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()

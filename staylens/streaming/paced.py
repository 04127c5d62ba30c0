"""Tables as paced streams: few files a batch, stopped and started again where they were."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from staylens.session import scratch_dir
from staylens.streaming.events import read_stream
from staylens.streaming.run import newest_rows, start, update_writer


def write_slices(rows: DataFrame, path: str, slices: int, order: Sequence[str] = ()) -> None:
    """``rows`` as ``slices`` files or more, in ranges of ``order`` if given, for a source that is limited by files."""
    dealt = rows.repartitionByRange(slices, *order) if order else rows.repartition(slices)
    dealt.write.mode("append").parquet(path)


def paced_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 1, **options) -> DataFrame:
    """Rows of a growing folder of Parquet files, at most ``files_per_batch`` new files at a time.

    What a batch reads is fixed in the checkpoint's offset log before it runs, so a batch that was
    cut off is run again with the same files after a restart.
    """
    return read_stream(spark, "parquet", path, schema, maxFilesPerTrigger=files_per_batch, **options)


def stop_after(query: StreamingQuery, batches: int, pause: float = 0.02) -> bool:
    """Let ``query`` finish ``batches`` more batches, then stop it; True if it had not come to its end before."""
    first = None
    while query.isActive:
        progress = query.lastProgress
        if progress is not None:
            first = progress["batchId"] if first is None else first
            if progress["batchId"] - first + 1 >= batches:
                query.stop()
                return True
        time.sleep(pause)
    query.awaitTermination()  # raises what ended it
    return False


def in_stretches(launch: Callable[[], StreamingQuery], stops: Sequence[int]) -> int:
    """Run a finite query with a stop after each number of batches in ``stops``; returns how often it was started."""
    started = 0
    for batches in stops:
        started += 1
        if not stop_after(launch(), batches):
            return started
    launch().awaitTermination()
    return started + 1


def replay_in_stretches(
    spark: SparkSession, result: Callable[[], DataFrame], keys: Sequence[str], name: str, stops: Sequence[int] = (2, 3)
) -> DataFrame:
    """Like :func:`staylens.streaming.run.replay`, but the query is stopped and started anew from its checkpoint.

    ``result`` builds the stream afresh for each start, as a new driver would.
    """
    folder = scratch_dir(spark, name)
    write = update_writer(f"{folder}/out")
    stream = result()
    in_stretches(
        lambda: start(result(), name, f"{folder}/checkpoint", mode="update", every=None, handler=write), stops
    )
    return newest_rows(spark, f"{folder}/out", stream.schema, keys)

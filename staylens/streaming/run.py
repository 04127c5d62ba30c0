"""Starting, running and replaying stream queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from staylens.session import make_folder, scratch_dir
from staylens.streaming.monitors import MONITORS


def start(
    df: DataFrame,
    name: str,
    checkpoint: str,
    sink: str = "console",
    mode: str = "append",
    every: str | None = "1 minute",
    order_by: Sequence[Column] = (),
    path: str | None = None,
    handler=None,
    **options,
) -> StreamingQuery:
    """Start one query. ``every=None`` handles what is there and stops.

    The checkpoint is required: offsets and state must outlive a lost driver. Sorted
    output needs ``complete`` mode, whose state grows with the result; monitors meant to
    run for long use ``append`` or ``update`` with a watermark.
    """
    if order_by:
        if mode != "complete":
            raise ValueError("only complete output can be sorted")
        df = df.orderBy(*order_by)
    writer = df.writeStream.outputMode(mode).queryName(name).option("checkpointLocation", checkpoint)
    writer = writer.options(**{k: str(v) for k, v in options.items()})
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    if handler is not None:
        return writer.foreachBatch(handler).start()
    writer = writer.format(sink)
    return writer.start(path) if path else writer.start()


def start_monitors(
    events: DataFrame, checkpoint_root: str, mode: str = "update", every: str | None = "1 minute",
    watermark: str | None = "10 minutes", sink: str = "console",
) -> list[StreamingQuery]:
    """The four reservation monitors, each with its own checkpoint.

    ``update`` with a watermark keeps the state bounded. ``complete`` can be sorted for
    display but keeps every window for ever.
    """
    queries = []
    for name, (monitor, order, rows) in MONITORS.items():
        result = monitor(events, watermark) if watermark else monitor(events)
        order_by = order() if mode == "complete" else []
        extra = {"truncate": "false", "numRows": rows} if sink == "console" else {}
        queries.append(
            start(result, name, f"{checkpoint_root}/{name}", sink, mode, every, order_by, **extra)
        )
    return queries


def run_all(spark: SparkSession, queries: Sequence[StreamingQuery], finite: bool = False) -> None:
    """Wait for the first query to end, or for all of them if the input is finite.

    A query that fails raises here.
    """
    if finite:
        for query in queries:
            query.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


def collect_stream(spark: SparkSession, result: DataFrame, name: str) -> DataFrame:
    """Run a stream without aggregates over everything its source holds; return its rows."""
    folder = scratch_dir(spark, name)
    start(
        result, name, f"{folder}/checkpoint", "parquet", "append", every=None, path=f"{folder}/out"
    ).awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{folder}/out")


def update_writer(out: str):
    """Handler that writes the changed groups of a batch to a folder of its own, which a repeated batch overwrites."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return write


def newest_rows(spark: SparkSession, out: str, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """The newest row of every group that :func:`update_writer` wrote."""
    fields = StructType([*schema.fields, StructField("batch", IntegerType())])
    make_folder(spark, out)  # an empty source has no batch
    written = spark.read.schema(fields).parquet(out)
    newest = F.max_by(F.struct(*[c for c in schema.names if c not in keys]), "batch")
    return written.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*").select(*schema.names)


def replay(spark: SparkSession, result: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Run an aggregating stream over everything its source holds; return the final rows.

    Groups of the last, still open windows are included.
    """
    folder = scratch_dir(spark, name)
    query = start(
        result, name, f"{folder}/checkpoint", mode="update", every=None, handler=update_writer(f"{folder}/out")
    )
    query.awaitTermination()
    return newest_rows(spark, f"{folder}/out", result.schema, keys)

"""Monitors over the events table, run as real stream queries that stop at its end."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.plans.table_questions import flag
from staylens.session import scratch_dir
from staylens.sources import read_table
from staylens.streaming import events as E
from staylens.streaming import monitors as M
from staylens.streaming import paced, panes
from staylens.streaming.run import collect_stream, replay, start
from staylens.streaming.watch import run_watched

#: Copies of one message id that may meet in a task.
DEDUPE_SALTS = 256
ROWS_PER_FILE = 2_000_000


def _events_path(folder: str) -> str:
    """A pattern that only the table's own name fits: a stream source takes a pattern or a folder, and this may be a file."""
    return f"{folder.rstrip('/')}/events.{{parquet}}"


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as a file stream, its zone-less time read as UTC."""
    schema = read_table(spark, folder, "events").schema
    stream = E.read_stream(spark, "parquet", _events_path(folder), schema)
    return shape(stream)


def shape(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("ts").cast("timestamp").alias("event_timestamp"),
        "event_type",
        (F.col("user_id") % 4).alias("user_group"),
        "value",
        flag(F.col("event_type") == "error").alias("is_canceled"),
    )


def _plain_times(df: DataFrame) -> DataFrame:
    """Window bounds without a zone, like the table they came from."""
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})


def stream_counts(spark: SparkSession, folder: str) -> DataFrame:
    result = M.windowed_counts(
        event_stream(spark, folder), ["event_type"], F.col("is_canceled"), duration="1 hour"
    )
    return _plain_times(replay(spark, result, ["window_start", "event_type"], "stream_counts"))


def stream_rate_alert(spark: SparkSession, folder: str) -> DataFrame:
    result = M.rate_alert(event_stream(spark, folder), ["user_group"], F.col("is_canceled"), duration="1 hour")
    return _plain_times(replay(spark, result, ["window_start", "user_group"], "stream_rate_alert"))


def stream_sliding_mean(spark: SparkSession, folder: str) -> DataFrame:
    kept = event_stream(spark, folder).filter(F.col("is_canceled") == 0)
    result = M.sliding_mean(kept, ["event_type"], F.col("value"), duration="5 hours", slide="1 hour")
    return _plain_times(replay(spark, result, ["period_start", "event_type"], "stream_sliding_mean"))


def stream_top_groups(spark: SparkSession, folder: str) -> DataFrame:
    """One micro-batch reads everything, so the watermark drops nothing."""
    result = M.top_groups(
        event_stream(spark, folder), ["event_type", "user_group"], F.col("value"), F.col("is_canceled"),
        duration="2 hours", slide="1 hour", watermark="2 hours",
    )
    return _plain_times(replay(spark, result, ["period_start", "event_type", "user_group"], "stream_top_groups"))


def stream_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per type after dropping repeated event ids on the stream."""
    schema = read_table(spark, folder, "events").schema
    stream = E.read_stream(spark, "parquet", _events_path(folder), schema)
    timed = stream.withColumn("event_timestamp", F.col("ts").cast("timestamp")).select(
        "event_id", "event_type", "event_timestamp"
    )
    # Every row twice, as a producer that sends again would.
    twice = timed.union(timed)
    once = collect_stream(spark, E.dedupe(twice), "stream_dedupe")
    return once.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


def parse_events(spark: SparkSession, folder: str) -> DataFrame:
    """JSON text of the events table as a typed column."""
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    return E.parse_json(read_table(spark, folder, "events"), schema, "props", keep=["event_id"])


def event_envelope(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events").select(
        F.col("event_id").alias("source_id"), "user_id", "event_type", "value", "ts"
    )
    when = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    rows = events.withColumn("sent", when).drop("ts")
    return E.to_event_envelope(rows, "event_type", F.col("sent"), ["source_id"])


def _sliced_events(spark: SparkSession, folder: str, slices: int = 12) -> tuple[str, T.StructType, int]:
    """The events in at least ``slices`` files; their folder, schema, and files a batch for that many batches."""
    events = read_table(spark, folder, "events")
    files = max(slices, events.count() // ROWS_PER_FILE)
    path = scratch_dir(spark, "event-slices")
    paced.write_slices(events, path, files)
    return path, events.schema, -(-files // slices)


def stream_restarted_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The counts of :func:`stream_counts`, a few files at a time, stopped and started again twice on the way."""
    path, schema, files = _sliced_events(spark, folder)

    def result() -> DataFrame:
        events = shape(paced.paced_stream(spark, path, schema, files))
        return M.windowed_counts(events, ["event_type"], F.col("is_canceled"), duration="1 hour")

    return _plain_times(paced.replay_in_stretches(spark, result, ["window_start", "event_type"], "stream_restarted_counts", (3, 4)))


def stream_pane_mean(spark: SparkSession, folder: str) -> DataFrame:
    """The sliding mean by chained aggregates, hourly panes summed into windows of five hours.

    A window comes out when the watermark has passed it, so the stream ends with a row that only
    carries a late time.
    """
    events = shape(read_table(spark, folder, "events")).filter(F.col("is_canceled") == 0).withColumn("counted", F.lit(True))
    end = events.agg((F.max("event_timestamp") + F.expr("INTERVAL 12 HOURS")).alias("event_timestamp"))
    end = end.filter(F.col("event_timestamp").isNotNull()).withColumn("counted", F.lit(False))
    path = scratch_dir(spark, "event-panes")
    events.unionByName(end, allowMissingColumns=True).write.parquet(path)
    stream = E.read_stream(spark, "parquet", path, events.schema)
    parts = panes.panes(stream, ["event_type"], F.col("value"), slide="1 hour", watermark="1 hour", counted=F.col("counted"))
    result = panes.sliding_mean(parts, ["event_type"], "5 hours", "1 hour")
    return _plain_times(collect_stream(spark, result, "stream_pane_mean"))


def stream_pane_top(spark: SparkSession, folder: str) -> DataFrame:
    """The report of :func:`stream_top_groups` from stored panes; open windows are in it too."""
    keys = ["event_type", "user_group"]
    parts = panes.panes(event_stream(spark, folder), keys, F.col("value"), F.col("is_canceled"), slide="1 hour")
    stored = replay(spark, parts, ["window", *keys], "stream_pane_top")
    return _plain_times(panes.top_groups(stored, keys, "2 hours", "1 hour"))


def stream_dedupe_hot(spark: SparkSession, folder: str) -> DataFrame:
    """Messages sent twice, a third of them with one id: each id once."""
    schema = read_table(spark, folder, "events").schema
    stream = E.read_stream(spark, "parquet", _events_path(folder), schema)
    message = F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.col("event_id").cast("string"))
    timed = stream.select(message.alias("message"), F.col("ts").cast("timestamp").alias("event_timestamp"))
    once = collect_stream(spark, E.dedupe(timed.union(timed), "message", salts=DEDUPE_SALTS), "stream_dedupe_hot")
    return once.groupBy("message").agg(F.count(F.lit(1)).alias("kept"))


def stream_watched(spark: SparkSession, folder: str) -> DataFrame:
    """Two monitors run as one watched group: rows each of them read, from the recorded progress."""
    root = scratch_dir(spark, "watched")
    flag_, events = F.col("is_canceled"), event_stream(spark, folder)
    group = {
        "counts": M.windowed_counts(events, ["event_type"], flag_, duration="1 hour"),
        "alerts": M.rate_alert(events, ["user_group"], flag_, duration="1 hour"),
    }
    tag = uuid.uuid4().hex[:8]
    running = [start(df, f"{name}-{tag}", f"{root}/{name}", "noop", "update", every=None) for name, df in group.items()]
    progress = run_watched(spark, running)
    return progress.groupBy(F.split_part("query", F.lit("-"), F.lit(1)).alias("monitor")).agg(F.sum("input_rows").alias("rows_read"))


def message_rejections(spark: SparkSession, folder: str) -> DataFrame:
    """Messages with one fault each, made of the events by their id: none of the faults stops the stream."""
    n = F.col("event_id")
    rate = F.when(n % 7 == 1, "NaN").when(n % 7 == 2, "Infinity").when(n % 7 == 3, "-1.5").otherwise(F.coalesce(F.abs("value"), F.lit(0.0)).cast("string"))
    when = F.when(n % 11 == 0, "some day").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    text = F.format_string(
        '{"adr": %s, "adults": %s, "hotel": %s, "event_time": "%s", "is_canceled": 0}',
        rate, F.when(n % 13 == 0, "0").otherwise("2"), F.when(n % 17 == 0, "null").otherwise('"City Hotel"'), when,
    )
    path = scratch_dir(spark, "faulty-messages")
    read_table(spark, folder, "events").select(F.when(n % 19 == 0, "no json").otherwise(text).alias("value")).write.parquet(path)
    raw = E.read_stream(spark, "parquet", path, "value string")
    rejected = replay(spark, E.rejected_counts(raw), ["reason"], "message_rejections")
    # The monitor that sums rates runs over the same messages.
    parts = panes.panes(E.parse_events(raw), ["hotel"], F.col("adr"), slide="1 day")
    kept = replay(spark, parts, ["window", "hotel"], "message_panes").agg(F.coalesce(F.sum("total"), F.lit(0)).alias("messages"))
    return rejected.unionByName(kept.withColumn("reason", F.lit("accepted")))

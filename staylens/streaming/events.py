"""Building and parsing event messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.functions import MISSING_TOKENS
from staylens.schemas import EVENT

UNKNOWN = "Unknown"


def event_id(columns: Sequence[str]) -> Column:
    """Identifier from the row's values: the same row sent twice gets the same id."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns]
    return F.concat(F.lit("BKG-"), F.sha2(F.concat_ws("|", *parts), 256))


def to_event_envelope(
    df: DataFrame,
    key: str = "hotel",
    event_time: Column | None = None,
    id_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows -> (key, value) messages, value being JSON with ``event_time`` and ``event_id``.

    Nulls are filled by type: 0 in numbers, ``Unknown`` in text, so a column never
    changes its type on the way.
    """
    if event_time is None:
        event_time = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
    identity = event_id(list(id_columns or df.columns))
    filled = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.NumericType):
            column = F.coalesce(column, F.lit(0).cast(field.dataType))
        elif isinstance(field.dataType, T.StringType):
            column = F.coalesce(column, F.lit(UNKNOWN))
        filled.append(column.alias(field.name))
    body = F.struct(*filled, event_time.alias("event_time"), identity.alias("event_id"))
    return df.select(
        F.coalesce(F.col(key).cast("string"), F.lit(UNKNOWN)).alias("key"),
        F.to_json(body).alias("value"),
    )


def write_messages(messages: DataFrame, sink: str = "kafka", path: str | None = None, **options) -> None:
    """Send (key, value) rows to a message topic, or to files with ``path``.

    Client settings such as compression go through as ``kafka.*`` options.
    """
    writer = messages.write.format(sink).options(**{k: str(v) for k, v in options.items()})
    if path:
        writer.mode("overwrite").save(path)
    else:
        writer.save()


def read_stream(spark: SparkSession, source: str, path: str | None = None, schema=None, **options) -> DataFrame:
    """Streaming source. ``source='kafka'`` takes its options; file sources take a path."""
    reader = spark.readStream.format(source)
    if schema is not None:
        reader = reader.schema(schema)
    reader = reader.options(**{k: str(v) for k, v in options.items()})
    return reader.load(path) if path else reader.load()


def kafka_options(servers: str, topic: str, per_trigger: int | None = None, start: str = "latest") -> dict[str, str]:
    """Options of the message source: one topic, new messages only; ``per_trigger`` bounds a batch."""
    limit = {"maxOffsetsPerTrigger": str(per_trigger)} if per_trigger else {}
    return {
        "kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start, "failOnDataLoss": "false", **limit,
    }


def parse_json(df: DataFrame, schema: T.StructType, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Bytes or text -> one column per schema field; text that is no JSON gives nulls.

    The fields come from a generator, as filters are not moved below one: moved below a projection,
    a filter parses the text again for every mention of a field.
    """
    parsed = F.from_json(F.col(value).cast("string"), schema)
    return df.select(*keep, F.inline(F.array(parsed)))


def rejection(times: str = "event_timestamp") -> Column:
    """Why an event does not count, or null if it does: the first reason that holds.

    A rate must be a number of 0 or more; JSON readers let NaN and infinities through.
    """
    rate = F.col("adr")
    no_rate = rate.isNull() | F.isnan(rate) | (rate == float("inf")) | (rate < 0)
    return (
        F.when(F.col(times).isNull(), "no_time")
        .when(no_rate, "no_rate")
        .when(~F.coalesce(F.col("adults") > 0, F.lit(False)), "no_adults")
        .when(F.col("hotel").isNull(), "no_hotel")
    )


def valid_only(events: DataFrame) -> DataFrame:
    """Events with a time, a finite rate of 0 or more, at least one adult and a hotel."""
    return events.filter(rejection().isNull())


def _timed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    return parse_json(raw, schema).withColumn("event_timestamp", F.col("event_time").try_cast("timestamp"))


def parse_events(raw: DataFrame, schema: T.StructType = EVENT) -> DataFrame:
    """Messages -> valid reservation events. A bad time drops the row, not the query."""
    return valid_only(_timed(raw, schema))


def rejected_counts(raw: DataFrame, schema: T.StructType = EVENT) -> DataFrame:
    """Messages that do not become events, by reason."""
    reasons = _timed(raw, schema).select(rejection().alias("reason")).filter(F.col("reason").isNotNull())
    return reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))


def dedupe(
    events: DataFrame, key: str = "event_id", time_col: str = "event_timestamp", delay: str = "10 minutes", salts: int = 1
) -> DataFrame:
    """Drop messages sent again; state is kept for ``delay`` only.

    With ``salts`` above 1, copies are first dropped per (id, salt), each message drawing its salt. Then no
    task meets more than ``salts`` copies of one id, however often it was sent, and which copy stays
    is as open as without. An id that is not repeated costs a second state row.
    """
    events = events.withWatermark(time_col, delay)
    if salts > 1:
        salt = F.floor(F.rand() * salts)
        events = events.withColumn("_salt", salt).dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt")
    return events.dropDuplicatesWithinWatermark([key])


def known_country(column: str = "country") -> Column:
    """True unless the country is null, a missing token, or the 0 of an untyped fill."""
    return F.col(column).isNotNull() & ~F.col(column).isin(*MISSING_TOKENS, "0", UNKNOWN)

"""All reservation monitors from one read and one parse of the source.

Every micro-batch is parsed once and reduced, in one pass, to sums per minute and all keys, of which the
sums per window and key of each monitor are made. Sums of
different batches add up, so no streaming state is needed, a late event is never lost,
and a batch that is run again just overwrites its own folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from staylens.functions import alert_level, stable_round, units_or_null
from staylens.session import kept, make_folder
from staylens.streaming.events import dedupe, known_country
from staylens.streaming.monitors import MIN_COUNT
from staylens.streaming.run import start

# Rates are summed in millionths; a long holds nine million million of them.
AMOUNT_SCALE = 6
AMOUNT = 10**AMOUNT_SCALE
_SUMS = ["total", "confirmed", "canceled", "amount", "rated", "nights", "stays"]
#: All that the monitors group or choose by.
_KEYS = ["hotel", "deposit_type", "reserved_room_type", "country", "is_canceled"]


@dataclass(frozen=True)
class Summary:
    """Which rows, windows and keys to sum, and how to turn the sums into the report."""

    rows: Callable[[DataFrame], DataFrame]
    keys: Sequence[str]
    duration: str
    slide: str | None
    finish: Callable[[DataFrame], DataFrame]


def _rate(digits: int):
    return F.round(F.col("canceled") / F.col("total") * 100, digits).alias("cancel_rate_pct")


def _mean_rate():
    return stable_round(F.try_divide(F.col("amount") / AMOUNT, F.col("rated")), 2)


def _counts(t: DataFrame) -> DataFrame:
    return t.select("window_start", "window_end", "hotel", F.col("total").alias("total_bookings"), "confirmed", "canceled")


def _alerts(t: DataFrame) -> DataFrame:
    rates = t.select(
        "window_start", "hotel", "deposit_type", F.col("total").alias("total_bookings"),
        F.col("canceled").alias("total_canceled"), _rate(2),
    )
    return rates.withColumn("alert", alert_level(F.col("cancel_rate_pct")))


def _rates(t: DataFrame) -> DataFrame:
    return t.filter(F.col("total") >= MIN_COUNT).select(
        F.col("window_start").alias("period_start"), F.col("window_end").alias("period_end"), "hotel",
        F.col("reserved_room_type").alias("room_type"), F.col("total").alias("booking_count"),
        _mean_rate().alias("avg_daily_rate"), F.round(F.col("amount") / AMOUNT, 2).alias("revenue_proxy"),
        stable_round(F.try_divide(F.col("nights"), F.col("stays")), 1).alias("avg_stay_nights"),
    )


def _countries(t: DataFrame) -> DataFrame:
    return t.select(
        F.col("window_start").alias("period_start"), "country", "hotel", F.col("total").alias("booking_count"),
        _mean_rate().alias("avg_spend"), _rate(1),
    )


SUMMARIES = {
    "bookings_per_minute": Summary(lambda e: e, ["hotel"], "1 minute", None, _counts),
    "cancellation_alerts": Summary(lambda e: e, ["hotel", "deposit_type"], "1 minute", None, _alerts),
    "rate_over_time": Summary(
        lambda e: e.filter(F.col("is_canceled") == 0), ["hotel", "reserved_room_type"], "5 minutes", "1 minute", _rates
    ),
    "top_countries": Summary(
        lambda e: e.filter(known_country()), ["country", "hotel"], "2 minutes", "1 minute", _countries
    ),
}


def minutes(events: DataFrame) -> DataFrame:
    """Sums of one batch per minute and all keys of the monitors, whose windows all begin and end with a minute."""
    night = F.col("stays_in_week_nights") + F.col("stays_in_weekend_nights")
    amount = units_or_null(F.col("adr"), AMOUNT_SCALE)
    grouped = events.groupBy(F.window("event_timestamp", "1 minute").alias("w"), *_KEYS).agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(amount).alias("amount"),
        F.count(amount).alias("rated"),
        F.sum(night).alias("nights"),
        F.count(night).alias("stays"),
    )
    return grouped.select(F.col("w.start").alias("event_timestamp"), *_KEYS, "total", "amount", "rated", "nights", "stays")


def sums(parts: DataFrame, summary: Summary) -> DataFrame:
    """Sums of one batch for one monitor, from those of :func:`minutes`."""
    window = F.window("event_timestamp", summary.duration, summary.slide)
    flag = F.col("is_canceled")
    grouped = summary.rows(parts).groupBy(window.alias("w"), *summary.keys).agg(
        F.sum("total").alias("total"),
        F.sum(F.when(flag == 0, F.col("total")).otherwise(0)).alias("confirmed"),
        F.sum(F.when(flag == 1, F.col("total")).otherwise(0)).alias("canceled"),
        *[F.sum(c).alias(c) for c in ("amount", "rated", "nights", "stays")],
    )
    return grouped.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *summary.keys, *_SUMS
    )


def start_fan_out(
    events: DataFrame, folder: str, checkpoint: str, every: str | None = "1 minute", resent_within: str | None = None
) -> StreamingQuery:
    """Write the sums of every batch below ``folder``, one sub-folder per monitor.

    ``resent_within`` drops messages whose id came before, within that span of event time;
    events later than it are then dropped too, as their ids are no longer known.
    """
    if resent_within:
        events = dedupe(events, delay=resent_within)

    def write(batch: DataFrame, number: int) -> None:
        with kept(minutes(batch)) as parts:
            for name, summary in SUMMARIES.items():
                sums(parts, summary).write.mode("overwrite").parquet(f"{folder}/{name}/batch={number}")

    return start(events, "fan_out", checkpoint, every=every, handler=write)


def report(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Current state of one monitor: the sums of all batches so far."""
    summary = SUMMARIES[name]
    make_folder(spark, f"{folder}/{name}")  # there may be no batch yet
    keys = ["window_start timestamp", "window_end timestamp", *[f"{k} string" for k in summary.keys]]
    written = spark.read.schema(", ".join([*keys, *[f"{c} bigint" for c in _SUMS]])).parquet(f"{folder}/{name}")
    merged = written.groupBy("window_start", "window_end", *summary.keys).agg(
        *[F.sum(c).alias(c) for c in _SUMS]
    )
    return summary.finish(merged)

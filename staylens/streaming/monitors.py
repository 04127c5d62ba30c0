"""Windowed monitors. They work on streams and on static tables alike.

``watermark`` bounds the state of a stream; leave it out only for complete output or
finite input. Sorting belongs to the sink (see :mod:`staylens.streaming.run`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions import ALERT_LEVELS, alert_level, exact_sum, stable_round, units_or_null
from staylens.operators.groups import rate_measures
from staylens.streaming.events import known_country

# Fixed value: windows with fewer rows say nothing about a mean.
MIN_COUNT = 5


def _windowed(
    events: DataFrame, time_col: str, keys: Sequence[str], duration: str, slide: str | None, watermark: str | None
):
    if watermark:
        events = events.withWatermark(time_col, watermark)
    window = F.window(time_col, duration, slide) if slide else F.window(time_col, duration)
    return events.groupBy(window, *keys)


def windowed_counts(
    events: DataFrame, keys: Sequence[str], flag: Column, time_col: str = "event_timestamp",
    duration: str = "1 minute", watermark: str | None = None,
) -> DataFrame:
    """All, confirmed and canceled events per tumbling window and key."""
    counts = _windowed(events, time_col, keys, duration, None, watermark).agg(
        F.count(F.lit(1)).alias("total_bookings"),
        F.count_if(flag == 0).alias("confirmed"),
        F.count_if(flag == 1).alias("canceled"),
    )
    return counts.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *keys, "total_bookings", "confirmed", "canceled",
    )


def rate_alert(
    events: DataFrame, keys: Sequence[str], flag: Column, time_col: str = "event_timestamp",
    duration: str = "1 minute", watermark: str | None = None, levels=ALERT_LEVELS,
) -> DataFrame:
    """Cancel rate per tumbling window and key, with an alert level."""
    rates = _windowed(events, time_col, keys, duration, None, watermark).agg(
        F.count(F.lit(1)).alias("total_bookings"),
        F.sum(flag.cast("bigint")).alias("total_canceled"),
        *rate_measures(flag, "cancel_rate_pct", null_in_denominator=True),
    )
    return rates.select(
        F.col("window.start").alias("window_start"), *keys, "total_bookings", "total_canceled",
        "cancel_rate_pct", alert_level(F.col("cancel_rate_pct"), levels).alias("alert"),
    )


def sliding_mean(
    events: DataFrame, keys: Sequence[str], value: Column, nights: Column | None = None,
    time_col: str = "event_timestamp", duration: str = "5 minutes", slide: str = "1 minute",
    min_count: int = MIN_COUNT, watermark: str | None = None,
) -> DataFrame:
    """Mean and sum of a rate per sliding window and key, for windows with enough rows.

    A value that is no amount (NaN, infinite) counts as a row and in neither measure.
    """
    amount = units_or_null(value, 6)
    measures = [
        F.count(F.lit(1)).alias("booking_count"),
        stable_round(F.avg(F.when(amount.isNotNull(), value)), 2).alias("avg_daily_rate"),
        F.round(exact_sum(amount, 6), 2).cast("double").alias("revenue_proxy"),
    ]
    names = ["booking_count", "avg_daily_rate", "revenue_proxy"]
    if nights is not None:
        measures.append(stable_round(F.avg(nights), 1).alias("avg_stay_nights"))
        names.append("avg_stay_nights")
    means = _windowed(events, time_col, keys, duration, slide, watermark).agg(*measures)
    return means.filter(F.col("booking_count") >= min_count).select(
        F.col("window.start").alias("period_start"), F.col("window.end").alias("period_end"), *keys, *names
    )


def top_groups(
    events: DataFrame, keys: Sequence[str], value: Column, flag: Column, time_col: str = "event_timestamp",
    duration: str = "2 minutes", slide: str = "1 minute", watermark: str | None = "2 minutes",
) -> DataFrame:
    """T4: volume, mean spend and cancel rate per sliding window and key."""
    groups = _windowed(events, time_col, keys, duration, slide, watermark).agg(
        F.count(F.lit(1)).alias("booking_count"),
        stable_round(F.avg(value), 2).alias("avg_spend"),
        *rate_measures(flag, "cancel_rate_pct", digits=1, null_in_denominator=True),
    )
    return groups.select(
        F.col("window.start").alias("period_start"), *keys, "booking_count", "avg_spend", "cancel_rate_pct"
    )


# The four reservation monitors with their usual keys, windows and display order.


def bookings_per_minute(events: DataFrame, watermark: str | None = None) -> DataFrame:
    return windowed_counts(events, ["hotel"], F.col("is_canceled"), watermark=watermark)


def cancellation_alerts(events: DataFrame, watermark: str | None = None) -> DataFrame:
    return rate_alert(events, ["hotel", "deposit_type"], F.col("is_canceled"), watermark=watermark)


def rate_over_time(events: DataFrame, watermark: str | None = None) -> DataFrame:
    """Only reservations that still stand."""
    kept = events.filter(F.col("is_canceled") == 0)
    nights = F.col("stays_in_week_nights") + F.col("stays_in_weekend_nights")
    named = kept.withColumnRenamed("reserved_room_type", "room_type")
    return sliding_mean(named, ["hotel", "room_type"], F.col("adr"), nights, watermark=watermark)


def top_countries(events: DataFrame, watermark: str | None = "2 minutes") -> DataFrame:
    known = events.filter(known_country())
    return top_groups(known, ["country", "hotel"], F.col("adr"), F.col("is_canceled"), watermark=watermark)


# name -> (monitor, display order, rows shown)
MONITORS = {
    "bookings_per_minute": (bookings_per_minute, lambda: [F.asc("window_start"), F.asc("hotel")], 20),
    "cancellation_alerts": (cancellation_alerts, lambda: [F.desc("cancel_rate_pct")], 30),
    "rate_over_time": (rate_over_time, lambda: [F.asc("period_start"), F.desc("avg_daily_rate")], 40),
    "top_countries": (top_countries, lambda: [F.desc("period_start"), F.desc("booking_count")], 15),
}

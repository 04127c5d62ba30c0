"""Sliding windows from panes.

A sliding window as such sends every event to duration / slide windows, and each of those
is a state row. Here an event is summed once, in the pane (a tumbling window of one slide)
it falls into; windows are then sums of panes. On a stream both steps are stateful and
chained, which needs ``append`` output: a window comes out when the watermark has passed its
end. Stored panes (``update`` output) can be combined into windows at any time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions import stable_round, units_or_null
from staylens.streaming.monitors import MIN_COUNT

# Amounts are summed in millionths; a long holds nine million million of them.
SCALE = 6
SUMS = ["total", "flagged", "amount", "valued", "nights", "stays"]


def panes(
    events: DataFrame, keys: Sequence[str], value: Column, flag: Column | None = None, nights: Column | None = None,
    time_col: str = "event_timestamp", slide: str = "1 minute", watermark: str | None = None, counted: Column | None = None,
) -> DataFrame:
    """Sums per pane and key that add up to those of any window. Rows that are not ``counted`` only move the watermark."""
    if watermark:
        events = events.withWatermark(time_col, watermark)
    here = F.lit(True) if counted is None else F.coalesce(counted, F.lit(False))
    amount = units_or_null(F.when(here, value), SCALE)
    long_stay = F.when(here, F.lit(None) if nights is None else nights).cast("bigint")
    return events.groupBy(F.window(time_col, slide), *keys).agg(
        F.count_if(here).alias("total"),
        F.sum(F.when(here, F.lit(0) if flag is None else flag).cast("bigint")).alias("flagged"),
        F.sum(amount).alias("amount"), F.count(amount).alias("valued"),
        F.sum(long_stay).alias("nights"), F.count(long_stay).alias("stays"),
    )


def combined(parts: DataFrame, keys: Sequence[str], duration: str, slide: str) -> DataFrame:
    """Windows from panes of one slide: ``(window, keys, sums)``. ``duration`` is a multiple of ``slide``."""
    at = F.window_time("window") if parts.isStreaming else F.col("window.start")
    placed = parts.withColumn("pane_time", at).drop("window")
    summed = placed.groupBy(F.window("pane_time", duration, slide), *keys).agg(*[F.sum(c).alias(c) for c in SUMS])
    return summed.filter(F.col("total") > 0)


def _mean(digits: int = 2) -> Column:
    return stable_round(F.try_divide(F.col("amount") / 10**SCALE, F.col("valued")), digits)


def sliding_mean(
    parts: DataFrame, keys: Sequence[str], duration: str = "5 minutes", slide: str = "1 minute",
    min_count: int = MIN_COUNT, nights: bool = False,
) -> DataFrame:
    """T3 from panes: mean and sum of a rate per sliding window and key, for windows with enough rows."""
    kept = combined(parts, keys, duration, slide).filter(F.col("total") >= min_count)
    stays = [stable_round(F.try_divide(F.col("nights"), F.col("stays")), 1).alias("avg_stay_nights")] if nights else []
    return kept.select(
        F.col("window.start").alias("period_start"), F.col("window.end").alias("period_end"), *keys,
        F.col("total").alias("booking_count"), _mean().alias("avg_daily_rate"),
        F.round(F.col("amount") / 10**SCALE, 2).alias("revenue_proxy"), *stays,
    )


def top_groups(parts: DataFrame, keys: Sequence[str], duration: str = "2 minutes", slide: str = "1 minute") -> DataFrame:
    """T4 from panes: volume, mean spend and cancel rate per sliding window and key."""
    return combined(parts, keys, duration, slide).select(
        F.col("window.start").alias("period_start"), *keys, F.col("total").alias("booking_count"), _mean().alias("avg_spend"),
        F.round(F.col("flagged") / F.col("total") * 100, 1).alias("cancel_rate_pct"),
    )

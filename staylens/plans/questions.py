"""The reservation questions, on cleaned reservation rows.

Each takes the reservations and returns a report. They read two to six columns, so a
Parquet scan below them is pruned to those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions import month_number, month_text, season_of_month, units
from staylens.operators import groups as G

MONTHS = [f"{m:02d}" for m in range(1, 13)]
YEAR, MONTH = "arrival_date_year", "arrival_date_month"


def _flag() -> Column:
    return F.col("is_canceled")


# Rates are taken to six places, so that only sums are rounded.
AMOUNT_SCALE = 6


def stay_amount() -> Column:
    """Rate times nights in millionths; a stay without nights brings no revenue."""
    return units(F.col("adr"), AMOUNT_SCALE) * (F.col("stays_in_week_nights") + F.col("stays_in_weekend_nights"))


def yearly_cancel_rate(bookings: DataFrame) -> DataFrame:
    """Cancel rate per year and its change."""
    return G.period_change(G.rate_by_group(bookings, [YEAR], _flag()), [YEAR], "cancel_rate")


def hotel_rank_per_year(bookings: DataFrame) -> DataFrame:
    """Cancel rate per year and hotel, ranked within the year."""
    rates = G.rate_by_group(bookings, [YEAR, "hotel"], _flag())
    return G.rank_within(rates, [F.desc("cancel_rate")], [YEAR]).orderBy(YEAR, "rank", "hotel")


def top_countries_per_hotel(bookings: DataFrame, n: int = 5) -> DataFrame:
    """Countries with most reservations per hotel."""
    known = bookings.filter(F.col("country").isNotNull())
    counts = G.distribution(known, ["hotel", "country"], "total_booking")
    return G.top_n_per_group(counts, ["hotel"], [F.desc("total_booking"), F.asc("country")], n, name="rn")


def country_hotel_matrix(bookings: DataFrame) -> DataFrame:
    """N3 as a matrix: one row per listed country, one column per hotel found, 0 where absent."""
    return G.pivot_matrix(top_countries_per_hotel(bookings), ["country"], "hotel", "total_booking")


def _numbered(months: DataFrame) -> DataFrame:
    """Add ``month_num`` to rows per month name: parsing names is for groups, not for rows."""
    named = months.withColumnRenamed(MONTH, "month_name")
    return named.withColumn("month_num", month_text(F.col("month_name")))


def _months(bookings: DataFrame) -> DataFrame:
    return _numbered(G.revenue_by_period(bookings, [YEAR, MONTH], stay_amount(), _flag() == 0, AMOUNT_SCALE))


def monthly_revenue(bookings: DataFrame) -> DataFrame:
    """Potential, actual and lost revenue per month, and growth of the actual."""
    grown = G.period_growth(_months(bookings), [YEAR, "month_num"], "revenue_actual", "growth_actual_pct")
    return grown.orderBy(YEAR, "month_num")


def monthly_revenue_peaks(bookings: DataFrame) -> DataFrame:
    """N4, read off: best month of each year, its label and the mean lost share."""
    months = _months(bookings).withColumn("month", F.col("month_num").cast("int"))
    peaks = G.peak_per_period(months, YEAR, ["month"], "revenue_actual", also=[F.avg("lost_pct").alias("mean_lost_pct")])
    label = F.concat_ws("-", F.col(YEAR).cast("string"), F.lpad(F.col("month").cast("string"), 2, "0"))
    return peaks.select(YEAR, label.alias("time_label"), "revenue_actual", "mean_lost_pct")


def peak_season_per_year(bookings: DataFrame) -> DataFrame:
    """Busiest season of each year, ties kept."""
    months = G.distribution(bookings, [YEAR, MONTH], "n")
    season = season_of_month(month_number(F.col(MONTH))).alias("season")
    counts = months.groupBy(YEAR, season).agg(F.sum("n").alias("total_booking"))
    return G.top_n_per_group(counts, [YEAR], [F.desc("total_booking")], 1, method="rank", name="rnk")


def top_rooms_per_hotel(bookings: DataFrame, n: int = 3) -> DataFrame:
    """Most reserved room types per hotel."""
    counts = G.distribution(bookings, ["hotel", "reserved_room_type"], "total_booking")
    order = [F.desc("total_booking"), F.asc("reserved_room_type")]
    return G.top_n_per_group(counts, ["hotel"], order, n).orderBy("hotel", "rank")


def main_channel_per_segment(bookings: DataFrame) -> DataFrame:
    """Most used channel of each market segment."""
    counts = G.distribution(bookings, ["market_segment", "distribution_channel"], "total_booking")
    order = [F.desc("total_booking"), F.asc("distribution_channel")]
    return G.top_n_per_group(counts, ["market_segment"], order, 1, name="rn")


def segment_rank(bookings: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Volume and cancel rate per market segment, ranked over all segments.

    ``exclude`` hides segments from the report after ranking.
    """
    rates = G.rate_by_group(bookings, ["market_segment"], _flag(), volume="total_booking")
    ranked = G.rank_within(rates, [F.desc("cancel_rate")])
    if exclude:
        ranked = ranked.filter(~F.col("market_segment").isin(*exclude))
    return ranked.orderBy(F.desc("cancel_rate"), "market_segment")


def guest_loyalty(bookings: DataFrame) -> DataFrame:
    """New against repeated guests."""
    return G.flag_label_rate(bookings, F.col("is_repeated_guest") == 1, "Repeated", "New", _flag())


def request_rank(bookings: DataFrame) -> DataFrame:
    """Volume and cancel rate by number of special requests."""
    key = "total_of_special_requests"
    rates = G.rate_by_group(bookings, [key], _flag(), volume="total_booking")
    return G.rank_within(rates, [F.desc(key)], name="request_rank").orderBy(F.desc(key))


def lead_time_rank(bookings: DataFrame) -> DataFrame:
    """Mean lead time by customer type."""
    means = G.mean_by_group(bookings, ["customer_type"], F.col("lead_time"), "avg_lead_time")
    return G.rank_within(means, [F.desc("avg_lead_time")], name="ranking")


def top_months_per_year(bookings: DataFrame, n: int = 3) -> DataFrame:
    """Months with most revenue per year, ties kept."""
    revenue = _numbered(G.amount_by_period(bookings, [YEAR, MONTH], stay_amount(), scale=AMOUNT_SCALE))
    top = G.top_n_per_group(revenue, [YEAR], [F.desc("revenue")], n, method="dense_rank")
    return top.withColumn("month_short", F.substring("month_name", 1, 3)).orderBy(YEAR, "rank", "month_num")


def month_year_matrix(bookings: DataFrame) -> DataFrame:
    """Revenue of every month, years as rows."""
    names = _numbered(G.amount_by_period(bookings, [YEAR, MONTH], stay_amount(), scale=AMOUNT_SCALE, digits=2))
    revenue = names.groupBy(YEAR, "month_num").agg(F.round(F.sum("revenue"), 0).alias("revenue"))
    return G.pivot_matrix(revenue, [YEAR], "month_num", "revenue", MONTHS, prefix="m")


def class_share(bookings: DataFrame) -> DataFrame:
    """Share of canceled and kept reservations."""
    return G.share_of_total(bookings, ["is_canceled"]).orderBy("is_canceled")

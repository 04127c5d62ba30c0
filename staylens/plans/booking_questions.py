"""The whole reservation path on rows derived from the order tables (see ``stays``)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.functions import is_missing
from staylens.operators import cleaning, features, profile, quantiles, split
from staylens.plans import questions as Q
from staylens.plans.stays import EXPRESSIONS, PARENT_COLUMNS, bookings
from staylens.schemas import TARGET
from staylens.plans.table_questions import rounded_summary
from staylens.session import scratch_dir, settled
from staylens.streaming import events as E
from staylens.streaming import monitors as M
from staylens.streaming.fanout import report, start_fan_out
from staylens.streaming.run import replay

Query = Callable[[SparkSession, str], DataFrame]


def _raw(spark: SparkSession, folder: str, parents: Sequence[str] = PARENT_COLUMNS) -> DataFrame:
    """Raw reservations with those of the joined columns that are in ``parents``."""
    names = [c for c in EXPRESSIONS if c not in PARENT_COLUMNS or c in parents]
    return bookings(spark, folder, names)


def cleaned(spark: SparkSession, folder: str, parents: Sequence[str] = PARENT_COLUMNS) -> DataFrame:
    return cleaning.clean(_raw(spark, folder, parents))


def missing(spark: SparkSession, folder: str) -> DataFrame:
    found = profile.missing_profile(_raw(spark, folder))
    return found.withColumn("missing_pct", F.round("missing_pct", 6))


def rules(spark: SparkSession, folder: str) -> DataFrame:
    return profile.rule_report(cleaning.fix_types(_raw(spark, folder)), cleaning.logic_rules())


def duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Equal rows without agent and company, on the hotel-side columns."""
    raw = _raw(spark, folder, parents=())
    nobody = is_missing("agent", "string") & is_missing("company", "string")
    keys = ["hotel", "is_canceled", "meal", "reserved_room_type", "adults", "stays_in_week_nights", "agent", "company"]
    return profile.duplicate_groups(raw, keys, nobody)


def full_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Rows equal in all 32 columns; the derived rows are read twice, so they are written first."""
    return profile.full_row_duplicates(settled(_raw(spark, folder), "raw"))


def full_summary(spark: SparkSession, folder: str) -> DataFrame:
    return profile.full_row_summary(_raw(spark, folder))


def summary(spark: SparkSession, folder: str) -> DataFrame:
    # Measured once: the quartiles take several passes over these columns.
    names = [
        "is_canceled", "lead_time", "arrival_date_year", "arrival_date_month", "arrival_date_week_number",
        "stays_in_weekend_nights", "stays_in_week_nights", "adults", "children", "babies", "meal",
        "is_repeated_guest", "previous_cancellations", "previous_bookings_not_canceled", "booking_changes",
        "days_in_waiting_list", "adr", "required_car_parking_spaces", "total_of_special_requests",
    ]
    rows = settled(cleaning.fix_types(_raw(spark, folder)).select(*names), "summary")
    numbers = [c for c in names if c not in ("arrival_date_month", "meal")]
    return rounded_summary(quantiles.with_quartiles(profile.numeric_summary(rows, names, quartiles=False), rows, numbers))


def bounds(spark: SparkSession, folder: str) -> DataFrame:
    rows = cleaning.fix_types(_raw(spark, folder, parents=()))
    table = quantiles.iqr_bounds(rows, ["adr", "adults", "children", "babies"], exact=True)
    return table.select("column", *[F.round(c, 6).alias(c) for c in table.columns[1:]])


def rate_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return quantiles.clipped_histogram(_raw(spark, folder, parents=()), "adr", 0, 500, 50)


def counts(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_counts(_raw(spark, folder, parents=()))


def model_columns(spark: SparkSession, folder: str) -> DataFrame:
    table = features.extract(cleaned(spark, folder))
    return table.withColumn("cancellation_rate", F.round("cancellation_rate", 6))


def split_balance(spark: SparkSession, folder: str) -> DataFrame:
    """Split by all model columns: copies of a row stay on one side."""
    tagged = split.tag_split(features.extract(cleaned(spark, folder)))
    return split.balance_report(tagged, TARGET)


def lead_times(spark: SparkSession, folder: str) -> DataFrame:
    table = Q.lead_time_rank(cleaned(spark, folder, ("lead_time", "customer_type")))
    return table.withColumn("avg_lead_time", F.round("avg_lead_time", 6))


def revenue_peaks(spark: SparkSession, folder: str) -> DataFrame:
    table = Q.monthly_revenue_peaks(cleaned(spark, folder, parents=()))
    return table.withColumn("mean_lost_pct", F.round("mean_lost_pct", 6))


def country_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Spaces in hotel names are replaced so that every engine accepts the column names."""
    table = Q.country_hotel_matrix(cleaned(spark, folder, ("country",)))
    return table.toDF(*[c.replace(" ", "_") for c in table.columns])


def _question(report: Callable[[DataFrame], DataFrame], *parents: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return report(cleaned(spark, folder, parents))

    return run


def message_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Reservations written as JSON messages, then read and parsed back as a stream.

    The week of the status date stands for the time of sending.
    """
    raw = cleaning.fix_types(_raw(spark, folder))
    messages = E.to_event_envelope(
        raw, event_time=F.date_format(F.date_trunc("week", "reservation_status_date"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    path = scratch_dir(spark, "messages")
    E.write_messages(messages, "parquet", path)
    return E.parse_events(E.read_stream(spark, "parquet", path, messages.schema))


def _monitor(name: str, keys: list[str]) -> Query:
    monitor = M.MONITORS[name][0]

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _plain_times(replay(spark, monitor(message_stream(spark, folder)), keys, name))

    return run


def _fan_out(name: str) -> Query:
    """The same report from the shared parse."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        out = scratch_dir(spark, "fan_out")
        start_fan_out(
            message_stream(spark, folder), f"{out}/sums", f"{out}/checkpoint", every=None
        ).awaitTermination()
        return _plain_times(report(spark, f"{out}/sums", name))

    return run


def _plain_times(table: DataFrame) -> DataFrame:
    times = [c for c in ("window_start", "window_end", "period_start", "period_end") if c in table.columns]
    return table.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


QUERIES: dict[str, Query] = {
    "booking_missing_profile": missing,
    "booking_rule_report": rules,
    "booking_duplicate_groups": duplicates,
    "booking_full_row_duplicates": full_duplicates,
    "booking_full_row_summary": full_summary,
    "booking_numeric_summary": summary,
    "booking_iqr_bounds": bounds,
    "booking_rate_histogram": rate_histogram,
    "booking_clean_counts": counts,
    "booking_cleaned": cleaned,
    "booking_features": model_columns,
    "booking_split_balance": split_balance,
    "booking_yearly_cancel_rate": _question(Q.yearly_cancel_rate),
    "booking_hotel_rank_per_year": _question(Q.hotel_rank_per_year),
    "booking_top_countries": _question(Q.top_countries_per_hotel, "country"),
    "booking_country_matrix": country_matrix,
    "booking_monthly_revenue": _question(Q.monthly_revenue),
    "booking_revenue_peaks": revenue_peaks,
    "booking_peak_season": _question(Q.peak_season_per_year),
    "booking_top_rooms": _question(Q.top_rooms_per_hotel),
    "booking_main_channel": _question(Q.main_channel_per_segment, "market_segment", "distribution_channel"),
    "booking_segment_rank": _question(Q.segment_rank, "market_segment"),
    "booking_guest_loyalty": _question(Q.guest_loyalty),
    "booking_request_rank": _question(Q.request_rank),
    "booking_lead_time_rank": lead_times,
    "booking_top_months": _question(Q.top_months_per_year),
    "booking_month_matrix": _question(Q.month_year_matrix),
    "booking_class_share": _question(Q.class_share),
    "booking_stream_counts": _monitor("bookings_per_minute", ["window_start", "hotel"]),
    "booking_stream_alerts": _monitor("cancellation_alerts", ["window_start", "hotel", "deposit_type"]),
    "booking_stream_rates": _monitor("rate_over_time", ["period_start", "hotel", "room_type"]),
    "booking_stream_countries": _monitor("top_countries", ["period_start", "country", "hotel"]),
    "booking_fan_out_counts": _fan_out("bookings_per_minute"),
    "booking_fan_out_countries": _fan_out("top_countries"),
    "booking_fan_out_alerts": _fan_out("cancellation_alerts"),
    "booking_fan_out_rates": _fan_out("rate_over_time"),
}

"""All registered queries by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from staylens.plans import (
    booking_models, booking_questions, handover_questions, model_facts, model_questions, scale_questions, stream_questions as S, table_questions as T,
)
from staylens.session import configure

Query = Callable[[SparkSession, str], DataFrame]

_TABLE_NAMES = [
    "monthly_revenue_growth", "yearly_rate_change", "yearly_rate_rank", "top_nations_per_segment",
    "nation_segment_matrix", "peak_season_per_year", "top_brands_per_type", "top_priority_per_segment",
    "segment_rate_rank", "flag_label_rate", "ordinal_rate_rank", "mean_gap_rank", "top_months_per_year",
    "month_year_matrix", "status_share", "peak_month_per_year", "missing_profile", "rule_report",
    "duplicate_summary", "duplicate_groups", "duplicate_documents", "full_row_summary", "full_row_duplicates", "line_copies", "numeric_summary",
    "summary_quartiles", "iqr_bounds", "iqr_bounds_approximate", "box_stats", "clipped_histogram",
    "discrete_distribution", "clean_orders", "impute_sentinel", "cap_outliers", "derived_features",
    "anti_join_orders", "hash_split_balance", "anti_join_test_set",
]
_STREAM_NAMES = [
    "parse_events", "event_envelope", "stream_counts", "stream_rate_alert", "stream_sliding_mean",
    "stream_top_groups", "stream_dedupe", "stream_restarted_counts", "stream_pane_mean", "stream_pane_top", "stream_dedupe_hot",
    "stream_watched", "message_rejections",
]


def _configured(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(configure(spark), folder)

    return run


def queries() -> dict[str, Query]:
    table = {name: getattr(T, name) for name in _TABLE_NAMES}
    table |= {name: getattr(S, name) for name in _STREAM_NAMES}
    table |= booking_questions.QUERIES | booking_models.QUERIES | model_questions.QUERIES
    table |= model_facts.QUERIES | scale_questions.QUERIES | handover_questions.QUERIES
    return {name: _configured(query) for name, query in table.items()}

"""Time the headline queries: median of three runs after one warm-up, one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from staylens.plans.catalog import queries  # noqa: E402
from staylens.session import shuffle_partitions  # noqa: E402

HEADLINE = [
    "monthly_revenue_growth", "yearly_rate_change", "yearly_rate_rank", "top_nations_per_segment",
    "peak_season_per_year", "top_brands_per_type", "top_priority_per_segment", "segment_rate_rank",
    "flag_label_rate", "ordinal_rate_rank", "mean_gap_rank", "top_months_per_year", "month_year_matrix",
    "status_share", "missing_profile", "rule_report", "duplicate_documents", "numeric_summary",
    "summary_quartiles", "iqr_bounds", "box_stats", "clipped_histogram", "clean_orders", "derived_features",
    "anti_join_orders", "hash_split_balance", "event_envelope", "stream_counts", "stream_rate_alert",
    "stream_sliding_mean", "stream_top_groups", "booking_missing_profile", "booking_rule_report",
    "booking_cleaned", "booking_features", "booking_monthly_revenue", "booking_segment_rank",
    "booking_stream_countries", "classify_lr", "cluster_sizes",
]


def table_bytes(folder: str) -> int:
    return sum(os.path.getsize(os.path.join(folder, f)) for f in os.listdir(folder))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    # Sized for the shuffle, which decoded is a few times the file size; adaptive execution merges small ones.
    parts = max(cpus, shuffle_partitions(4 * table_bytes(folder), cpus) // 2)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    table = queries()
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            begun = time.perf_counter()
            # The no-op sink computes every row and column without collecting them.
            table[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - begun)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total of median query seconds", "value": round(sum(seconds.values()), 3),
                "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/")),
                "cores": cpus, "driver_memory": "12g", "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

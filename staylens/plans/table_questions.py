"""The same question shapes on the order, event and document tables.

Every function takes the session and the table folder and reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.functions import fill_missing, season_of_month, stable_round, units
from staylens.operators import cleaning, features, groups as G, joins, profile, quantiles, split
from staylens.plans.questions import MONTHS
from staylens.sources import read_table

UNSPECIFIED = "4-NOT SPECIFIED"


def flag(test: Column) -> Column:
    return F.when(test, 1).otherwise(0)


def order_failed() -> Column:
    return flag(F.col("o_orderstatus") == "F")


# Price and discount are taken to four places each, so that only sums are rounded.
REVENUE_SCALE = 8


def line_revenue() -> Column:
    """Discounted price in units of ``REVENUE_SCALE`` places."""
    return units(F.col("l_extendedprice"), 4) * (10_000 - units(F.col("l_discount"), 4))


def _year(name: str) -> Column:
    return F.year(name).cast("bigint")


def _month(name: str) -> Column:
    return F.month(name).cast("bigint")


# -- rates, ranks, growth ---------------------------------------------------------


def monthly_revenue_growth(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem")
    period = {"year": _year("l_shipdate"), "month": _month("l_shipdate")}
    months = G.revenue_by_period(lines, period, line_revenue(), F.col("l_returnflag") != "R", REVENUE_SCALE)
    return G.period_growth(months, ["year", "month"], "revenue_actual", "growth_actual_pct").orderBy("year", "month")


def yearly_rate_change(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    rates = G.rate_by_group(orders, {"year": _year("o_orderdate")}, order_failed())
    return G.period_change(rates, ["year"], "cancel_rate")


def yearly_rate_rank(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    keys = {"year": _year("o_orderdate"), "o_orderpriority": F.col("o_orderpriority")}
    return G.rank_within(G.rate_by_group(orders, keys, order_failed()), [F.desc("cancel_rate")], ["year"])


def top_nations_per_segment(spark: SparkSession, folder: str) -> DataFrame:
    """Counts per nation key are joined to nation names, not the customers themselves."""
    customers = read_table(spark, folder, "customer")
    counts = G.distribution(customers, ["c_mktsegment", "c_nationkey"], "total_booking")
    named = counts.join(read_table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    per_name = named.groupBy("c_mktsegment", "n_name").agg(F.sum("total_booking").alias("total_booking"))
    return G.top_n_per_group(per_name, ["c_mktsegment"], [F.desc("total_booking"), F.asc("n_name")], 5, name="rn")


def nation_segment_matrix(spark: SparkSession, folder: str) -> DataFrame:
    top = top_nations_per_segment(spark, folder)
    return G.pivot_matrix(top, ["n_name"], "c_mktsegment", "total_booking")


def peak_season_per_year(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    keys = {"year": _year("o_orderdate"), "season": season_of_month(F.month("o_orderdate"))}
    counts = G.distribution(orders, keys, "total_booking")
    return G.top_n_per_group(counts, ["year"], [F.desc("total_booking")], 1, method="rank", name="rnk")


def top_brands_per_type(spark: SparkSession, folder: str) -> DataFrame:
    counts = G.distribution(read_table(spark, folder, "part"), ["p_type", "p_brand"], "total_booking")
    return G.top_n_per_group(counts, ["p_type"], [F.desc("total_booking"), F.asc("p_brand")], 3)


def _orders_by_segment(spark: SparkSession, folder: str, extra: list[str]) -> DataFrame:
    """Order counts per customer with the customer's segment.

    Orders are counted per customer before the join, so a customer with a third of all
    orders brings one row per priority to it.
    """
    per_customer = (
        read_table(spark, folder, "orders")
        .groupBy("o_custkey", *extra)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(order_failed()).alias("failed"))
    )
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return per_customer.join(customers, F.col("o_custkey") == F.col("c_custkey"))


def top_priority_per_segment(spark: SparkSession, folder: str) -> DataFrame:
    counts = (
        _orders_by_segment(spark, folder, ["o_orderpriority"])
        .groupBy("c_mktsegment", "o_orderpriority")
        .agg(F.sum("n").alias("total_booking"))
    )
    order = [F.desc("total_booking"), F.asc("o_orderpriority")]
    return G.top_n_per_group(counts, ["c_mktsegment"], order, 1, name="rn")


def segment_rate_rank(spark: SparkSession, folder: str) -> DataFrame:
    rates = G.rate_from_counts(
        _orders_by_segment(spark, folder, []), ["c_mktsegment"], "n", "failed", "cancel_rate", "total_booking"
    )
    return G.rank_within(rates, [F.desc("cancel_rate")])


def flag_label_rate(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem")
    returned = flag(F.col("l_returnflag") == "R")
    return G.flag_label_rate(lines, F.col("l_linestatus") == "O", "Open", "Closed", returned, "line_label")


def ordinal_rate_rank(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem")
    rates = G.rate_by_group(lines, ["l_linenumber"], flag(F.col("l_returnflag") == "R"), volume="total_booking")
    return G.rank_within(rates, [F.desc("l_linenumber")], name="request_rank")


def mean_gap_rank(spark: SparkSession, folder: str) -> DataFrame:
    """Mean days from order to shipment by priority.

    Lines are summed per order before the join, in whole days, so the mean is exact.
    """
    per_order = (
        read_table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.unix_date(F.to_date("l_shipdate"))).alias("days"))
    )
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", "o_orderpriority", F.unix_date(F.to_date("o_orderdate")).alias("ordered")
    )
    joined = per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    gap = F.sum(F.col("days") - F.col("n") * F.col("ordered")).cast("double") / F.sum("n")
    means = joined.groupBy("o_orderpriority").agg(F.round(gap, 6).alias("avg_gap_days"))
    return G.rank_within(means, [F.desc("avg_gap_days")], name="ranking")


def top_months_per_year(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem")
    period = {"year": _year("l_shipdate"), "month": _month("l_shipdate")}
    revenue = G.amount_by_period(lines, period, line_revenue(), scale=REVENUE_SCALE)
    return G.top_n_per_group(revenue, ["year"], [F.desc("revenue")], 3, method="dense_rank")


def month_year_matrix(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem")
    period = {"year": _year("l_shipdate"), "month": _month("l_shipdate")}
    revenue = G.amount_by_period(lines, period, line_revenue(), scale=REVENUE_SCALE).withColumn(
        "month_num", F.lpad(F.col("month").cast("string"), 2, "0")
    )
    return G.pivot_matrix(revenue, ["year"], "month_num", "revenue", MONTHS, prefix="m")


def status_share(spark: SparkSession, folder: str) -> DataFrame:
    return G.share_of_total(read_table(spark, folder, "orders"), ["o_orderstatus"])


def peak_month_per_year(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem")
    period = {"year": _year("l_shipdate"), "month": _month("l_shipdate")}
    months = G.revenue_by_period(lines, period, line_revenue(), F.col("l_returnflag") != "R", REVENUE_SCALE)
    return G.peak_per_period(months, "year", ["month"], "revenue_actual")


# -- profiling --------------------------------------------------------------------


def missing_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.missing_profile(
        read_table(spark, folder, "orders"), tokens=("NULL", "NA", UNSPECIFIED), keep_complete=True
    )


def line_rules() -> dict[str, Column]:
    return {
        "shipped_before_order": F.col("l_shipdate") < F.col("o_orderdate"),
        "no_discount_and_no_tax": (F.col("l_discount") == 0) & (F.col("l_tax") == 0),
        "quantity_over_45": F.col("l_quantity") > 45,
        "negative_price": F.col("l_extendedprice") < 0,
        "returned_but_order_open": (F.col("l_returnflag") == "R") & F.col("o_orderstatus").isin("O", "P"),
        "open_line_of_failed_order": (F.col("l_linestatus") == "O") & (F.col("o_orderstatus") == "F"),
        "large_line_small_order": (F.col("l_extendedprice") > 90000) & (F.col("o_totalprice") < 5000),
    }


def rule_report(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem")
    orders = read_table(spark, folder, "orders")
    return profile.rule_report(lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")), line_rules())


def duplicate_summary(spark: SparkSession, folder: str) -> DataFrame:
    return profile.duplicate_summary(read_table(spark, folder, "events"), ["user_id", "event_type"])


def duplicate_groups(spark: SparkSession, folder: str) -> DataFrame:
    return profile.duplicate_groups(read_table(spark, folder, "events"), ["user_id", "event_type"])


def full_row_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Every order line twice where its part is a tenth one: copies are counted on all columns."""
    return profile.full_row_summary(_with_copies(spark, folder))


def full_row_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return profile.full_row_duplicates(_with_copies(spark, folder))


def _with_copies(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem")
    times = F.when(F.col("l_partkey") % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return lines.withColumn("_copy", F.explode(times)).drop("_copy")


def duplicate_documents(spark: SparkSession, folder: str) -> DataFrame:
    return profile.duplicate_texts(read_table(spark, folder, "documents"), "text", "doc_id")


def line_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Equal (order, line number) pairs without a discount: the conditional form."""
    return profile.duplicate_groups(
        read_table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], F.col("l_discount") == 0
    )


SUMMARY_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def numeric_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Moments, range and exact quartiles; mean and deviation cut to six places for comparison."""
    lines = read_table(spark, folder, "lineitem")
    summary = profile.numeric_summary(lines, [*SUMMARY_COLUMNS, "l_returnflag"], quartiles=False)
    return rounded_summary(quantiles.with_quartiles(summary, lines, SUMMARY_COLUMNS))


def rounded_summary(summary: DataFrame) -> DataFrame:
    return summary.select(
        "column", "count", stable_round(F.col("mean"), 6).alias("mean"), F.round("stddev", 6).alias("stddev"),
        "min", "p25", "p50", "p75", "max", "min_text", "max_text",
    )


def summary_quartiles(spark: SparkSession, folder: str) -> DataFrame:
    return quantiles.exact_quantiles(
        read_table(spark, folder, "lineitem"), SUMMARY_COLUMNS, [0.25, 0.5, 0.75], method="rank"
    )


def iqr_bounds(spark: SparkSession, folder: str) -> DataFrame:
    bounds = quantiles.iqr_bounds(read_table(spark, folder, "events"), ["value"], exact=True)
    return bounds.select("column", *[F.round(c, 6).alias(c) for c in bounds.columns[1:]])


def iqr_bounds_approximate(spark: SparkSession, folder: str) -> DataFrame:
    return quantiles.iqr_bounds(read_table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"])


def box_stats(spark: SparkSession, folder: str) -> DataFrame:
    stats = quantiles.box_stats(read_table(spark, folder, "events"), "value")
    return stats.select("n", *[F.round(c, 6).alias(c) for c in stats.columns[1:6]], *stats.columns[6:])


def clipped_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return quantiles.clipped_histogram(read_table(spark, folder, "events"), "value", 0, 100, 50)


def discrete_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return G.distribution(read_table(spark, folder, "lineitem"), ["l_quantity"]).orderBy("l_quantity")


# -- cleaning, features, joins, split ----------------------------------------------


def clean_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Rules, imputation and caps on orders."""
    orders = read_table(spark, folder, "orders")
    ruled = orders.filter(
        (F.col("o_totalprice") >= 0) & ~((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 1000))
    )
    tokens = F.when(F.col("o_orderpriority") == UNSPECIFIED, "NULL").otherwise(F.col("o_orderpriority"))
    imputed = cleaning.impute(ruled.withColumn("o_orderpriority", tokens), {"o_orderpriority": "Unknown"})
    return cleaning.cap_outliers(imputed, {"o_totalprice": 450000.0}, {})


def impute_sentinel(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return orders.withColumns(
        {
            "o_orderpriority": fill_missing("o_orderpriority", "Unknown", (UNSPECIFIED,)),
            "o_orderstatus": fill_missing("o_orderstatus", "9999", ("P",)),
        }
    )


def cap_outliers(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    return cleaning.cap_outliers(lines, {"l_extendedprice": 90000.0}, {"l_quantity": 45})


def derived_features(spark: SparkSession, folder: str) -> DataFrame:
    history = features.history_features(
        read_table(spark, folder, "orders"), "o_custkey", F.col("o_orderstatus") == "F"
    )
    return history.withColumn("cancellation_rate", F.round("cancellation_rate", 6))


def anti_join_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders without a line."""
    lines = read_table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.anti_join(read_table(spark, folder, "orders"), lines, ["o_orderkey"])


def hash_split_balance(spark: SparkSession, folder: str) -> DataFrame:
    tagged = split.tag_split(read_table(spark, folder, "orders"), ["o_orderkey"])
    return split.balance_report(tagged, "o_orderstatus")


def anti_join_test_set(spark: SparkSession, folder: str) -> DataFrame:
    """Test rows as "all orders but the training orders"."""
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    _, test = split.stratified_split(orders, "o_orderstatus", ["o_orderkey"], method="anti_join")
    return test

import math
import random

import numpy as np
import pytest
from fixtures import bookings, rows
from pyspark.sql import functions as F

from staylens.operators import cleaning, profile, quantiles


def test_missing_profile_knows_three_forms(spark):
    df = bookings(
        spark, {}, {"agent": None}, {"agent": "NULL"}, {"country": "NA"}, {"adr": math.nan}, {"adr": None},
        {"company": "7", "children": "NA"},
    )
    got = {r["column"]: (r["missing"], r["valid"]) for r in profile.missing_profile(df).collect()}
    assert got == {"company": (6, 1), "agent": (2, 5), "adr": (2, 5), "country": (1, 6), "children": (1, 6)}
    assert profile.missing_profile(df).first()["column"] == "company"


def test_integer_column_next_to_a_token_does_not_raise(spark):
    df = spark.createDataFrame([(1,), (None,)], "agent int")
    assert profile.missing_profile(df).first()["missing"] == 1
    assert rows(cleaning.impute(df)) == [("1",), ("9999",)]


RULE_ROWS = {
    "no_guests": {"adults": 0},
    "no_nights_and_free": {"stays_in_weekend_nights": 0, "stays_in_week_nights": 0, "adr": 0.0},
    "waiting_beyond_lead_time": {"days_in_waiting_list": 31},
    "negative_rate": {"adr": -6.38},
    "status_contradicts_flag": {"is_canceled": 1},
    "minors_alone": {"adults": 0, "children": "1"},
    "repeated_without_history": {"is_repeated_guest": 1},
}


def test_each_rule_finds_its_row(spark):
    df = cleaning.fix_types(bookings(spark, {}, *RULE_ROWS.values()))
    report = profile.rule_report(df, cleaning.logic_rules())
    assert [(r["rule"], r["violations"]) for r in report.collect()] == [(name, 1) for name in RULE_ROWS]
    assert {r["rows_checked"] for r in report.collect()} == {8}


def test_no_show_is_a_conflict_only_when_not_canceled(spark):
    df = cleaning.fix_types(
        bookings(
            spark, {"reservation_status": "No-Show"}, {"reservation_status": "No-Show", "is_canceled": 1},
            {"reservation_status": "Canceled"}, {"reservation_status": "Canceled", "is_canceled": 1},
        )
    )
    found = {r["rule"]: r["violations"] for r in profile.rule_report(df, cleaning.logic_rules()).collect()}
    assert found["status_contradicts_flag"] == 2


def test_reports_are_one_job(spark):
    df = cleaning.fix_types(bookings(spark, *RULE_ROWS.values()))
    spark.sparkContext.setJobGroup("rules", "rules")
    profile.rule_report(df, cleaning.logic_rules()).collect()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("rules")
    spark.sparkContext.setJobGroup("", "")
    # Adaptive execution submits the shuffle and the result as jobs of one query.
    assert len(jobs) <= 2


def test_duplicates(spark):
    copy = {"agent": "NULL", "meal": "HB"}
    df = bookings(spark, copy, copy, copy, {"lead_time": 1}, {"lead_time": 1}, {})
    nobody = F.col("agent").isin("NULL", "NA") & F.col("company").isin("NULL", "NA")
    groups = profile.duplicate_groups(df, condition=nobody)
    assert rows(groups, "meal", "copies") == [("HB", 3)]
    assert rows(profile.duplicate_summary(df)) == [(6, 3, 2, 3)]


def test_duplicate_texts_with_one_text_in_a_third_of_all_rows(spark):
    texts = ["same words " * 50] * 300 + [f"text {i}" for i in range(598)] + ["pair"] * 2
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    got = rows(profile.duplicate_texts(df, "text", "doc_id"), "copies", "first_doc_id")
    assert got == [(2, 898), (300, 0)]


def test_summary_is_typed(spark):
    df = bookings(spark, {"adr": 10.0}, {"adr": 20.0}, {"adr": 30.0}, {"adr": None, "meal": "HB"})
    adr, meal = profile.numeric_summary(df, ["adr", "meal"]).collect()
    assert (adr["count"], adr["mean"], adr["stddev"], adr["min"], adr["p50"], adr["max"]) == (3, 20.0, 10.0, 10.0, 20.0, 30.0)
    assert (meal["count"], meal["mean"], meal["min_text"], meal["max_text"]) == (4, None, "BB", "HB")


def test_text_ranges_do_not_slow_the_numbers(spark):
    df = bookings(spark, {"adr": 10.0}, {"adr": 20.0, "meal": "HB"})
    summary = profile.numeric_summary(df, ["meal", "adr", "babies"], quartiles=False)
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert " HashAggregate" in plan and "SortAggregate" in plan
    assert [r["column"] for r in summary.collect()] == ["meal", "adr", "babies"]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value; the others spread over many sizes."""
    rng = random.Random(3)
    values = [7.25] * 4000 + [rng.lognormvariate(3, 3) for _ in range(8000)] + [math.nan, None]
    small = [float(rng.randint(0, 9)) for _ in values]
    df = spark.createDataFrame(list(zip(values, small)), "v double, w double").repartition(8).cache()
    return df, [v for v in values if v is not None and not math.isnan(v)], small


@pytest.mark.parametrize("finish", [1_000_000, 200, 16])
def test_exact_quantiles_match_brute_force(spark, skewed, finish):
    df, values, small = skewed
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {
        (r["column"], r["probability"]): r["value"]
        for r in quantiles.exact_quantiles(df, ["v", "w"], probabilities, finish_distinct=finish).collect()
    }
    for p in probabilities:
        assert got[("v", p)] == pytest.approx(np.quantile(values, p), rel=1e-12)
        assert got[("w", p)] == pytest.approx(np.quantile(small, p), rel=1e-12)


def test_exact_quantiles_by_rank(spark, skewed):
    df, values, _ = skewed
    got = quantiles.exact_quantiles(df, ["v"], [0.2, 0.5, 0.9], method="rank", finish_distinct=50).collect()
    ordered = sorted(values)
    assert [r["value"] for r in got] == [ordered[math.ceil(len(ordered) * p - 1e-9) - 1] for p in (0.2, 0.5, 0.9)]


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,), (math.nan,)], "v double")
    row = quantiles.exact_quantiles(df, ["v"], [0.5]).first()
    assert (row["n"], row["value"]) == (0, None)
    assert quantiles.box_stats(df, "v").first()["median"] is None


def test_approximate_bounds_are_close(spark, skewed):
    df, _, small = skewed
    row = quantiles.iqr_bounds(df, ["w"]).first()
    q1, q3 = np.quantile(small, [0.25, 0.75])
    assert abs(row["q1"] - q1) <= 1 and abs(row["q3"] - q3) <= 1
    assert row["upper_bound"] == row["q3"] + 1.5 * row["iqr"]


def test_box_stats(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 100.0, -50.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = quantiles.box_stats(df, "v").first()
    q1, q2, q3 = np.quantile(values, [0.25, 0.5, 0.75])
    assert (row["q1"], row["median"], row["q3"]) == (q1, q2, q3)
    assert (row["whisker_low"], row["whisker_high"], row["outliers_low"], row["outliers_high"]) == (1.0, 7.0, 1, 1)


def test_histogram_clips_and_closes_the_last_bin(spark):
    df = spark.createDataFrame([(-6.38,), (0.0,), (9.99,), (10.0,), (499.9,), (500.0,), (5400.0,), (None,)], "v double")
    got = [r["count"] for r in quantiles.clipped_histogram(df, "v", 0, 500, 50).orderBy("bin").collect()]
    assert got[0] == 3 and got[1] == 1 and got[49] == 3 and sum(got) == 7 and len(got) == 50
    assert got == list(np.histogram(np.clip([-6.38, 0, 9.99, 10, 499.9, 500, 5400], 0, 500), 50, (0, 500))[0])

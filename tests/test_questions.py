import pytest
from fixtures import bookings, rows
from pyspark.sql import functions as F

from staylens.functions import alert_level, month_number, month_text, season_of_month, stable_round
from staylens.operators import cleaning, groups as G
from staylens.plans import questions as Q


def table(spark, *changes):
    return cleaning.fix_types(bookings(spark, *changes))


def test_yearly_rate_change_is_rounded(spark):
    df = table(
        spark, *[{"arrival_date_year": 2015, "is_canceled": int(i < 1)} for i in range(3)],
        *[{"arrival_date_year": 2016, "is_canceled": int(i < 2)} for i in range(3)],
    )
    assert rows(Q.yearly_cancel_rate(df)) == [(2015, 33.33, None, None), (2016, 66.67, 33.33, 33.34)]


def test_ranks_share_ties(spark):
    df = table(spark, {"hotel": "A"}, {"hotel": "B"}, {"hotel": "C", "is_canceled": 1})
    assert rows(Q.hotel_rank_per_year(df), "hotel", "rank") == [("A", 2), ("B", 2), ("C", 1)]


def test_top_countries_break_ties_by_name_and_skip_null(spark):
    names = ["B", "A", "C", "D", "E", "F", None, None]
    got = rows(Q.top_countries_per_hotel(table(spark, *[{"country": c} for c in names])), "country", "rn")
    assert got == [("A", 1), ("B", 2), ("C", 3), ("D", 4), ("E", 5)]


def test_country_matrix_fills_zero(spark):
    df = table(spark, {"country": "A"}, {"country": "B", "hotel": "Resort Hotel"})
    got = Q.country_hotel_matrix(df)
    assert rows(got) == [("A", 1, 0), ("B", 0, 1)]


def test_monthly_revenue_growth_and_zero_month(spark):
    df = table(
        spark, {"arrival_date_month": "January", "is_canceled": 1}, {"arrival_date_month": "February"},
        {"arrival_date_month": "March"}, {"arrival_date_month": "March", "is_canceled": 1},
        {"arrival_date_month": "April", "adr": 0.0},
    )
    got = rows(Q.monthly_revenue(df), "month_num", "revenue_potential", "revenue_actual", "lost_pct", "growth_actual_pct")
    assert got == [
        ("01", 300.0, 0.0, 100.0, None), ("02", 300.0, 300.0, 0.0, None), ("03", 600.0, 300.0, 50.0, 0.0),
        ("04", 0.0, 0.0, None, -100.0),
    ]


def test_revenue_peaks(spark):
    df = table(spark, {"arrival_date_month": "May"}, {"arrival_date_month": "March"}, {"arrival_date_month": "June", "adr": 1.0})
    assert rows(Q.monthly_revenue_peaks(df)) == [(2016, "2016-03", 300.0, 0.0)]


def test_peak_season_keeps_ties(spark):
    df = table(spark, {"arrival_date_month": "December"}, {"arrival_date_month": "May"}, {"arrival_date_year": 2017})
    assert rows(Q.peak_season_per_year(df)) == [(2016, "Spring", 1, 1), (2016, "Winter", 1, 1), (2017, "Summer", 1, 1)]


def test_rooms_channels_and_segments(spark):
    df = table(
        spark, {"reserved_room_type": "D"}, {"reserved_room_type": "D"}, {"reserved_room_type": "B"}, {"reserved_room_type": "C"},
        {"distribution_channel": "TA/TO"}, {"market_segment": "Undefined", "is_canceled": 1},
    )
    assert rows(Q.top_rooms_per_hotel(df), "reserved_room_type", "rank") == [("A", 1), ("B", 3), ("D", 2)]
    assert rows(Q.main_channel_per_segment(df), "market_segment", "distribution_channel") == [
        ("Direct", "Direct"), ("Undefined", "Direct"),
    ]
    assert rows(Q.segment_rank(df)) == [("Direct", 5, 0.0, 2), ("Undefined", 1, 100.0, 1)]
    assert rows(Q.segment_rank(df, exclude=("Undefined",))) == [("Direct", 5, 0.0, 2)]


def test_loyalty_counts_unknown_as_new(spark):
    df = table(spark, {"is_repeated_guest": None}, {"is_canceled": 1}, {"is_repeated_guest": 1})
    assert rows(Q.guest_loyalty(df)) == [("New", 2, 50.0), ("Repeated", 1, 0.0)]


def test_requests_lead_time_and_shares(spark):
    df = table(spark, {"total_of_special_requests": 3, "lead_time": 10}, {"customer_type": "Group", "is_canceled": 1}, {})
    assert rows(Q.request_rank(df)) == [(0, 2, 50.0, 2), (3, 1, 0.0, 1)]
    assert rows(Q.lead_time_rank(df)) == [("Group", 30.0, 1), ("Transient", 20.0, 2)]
    assert rows(Q.class_share(df)) == [(0, 2, 66.67), (1, 1, 33.33)]


def test_top_months_and_matrix(spark):
    df = table(
        spark, {"arrival_date_month": "May"}, {"arrival_date_month": "June"}, {"arrival_date_month": "July", "adr": 50.0},
        {"arrival_date_month": "August", "adr": 20.0}, {"arrival_date_month": "March", "adr": 10.0},
    )
    assert rows(Q.top_months_per_year(df), "month_short", "revenue", "rank") == [
        ("Aug", 60.0, 3), ("Jul", 150.0, 2), ("Jun", 300.0, 1), ("May", 300.0, 1),
    ]
    matrix = Q.month_year_matrix(df).first()
    assert (matrix["m05"], matrix["m01"], len(matrix)) == (300.0, 0.0, 13)


def test_null_flags_in_both_kinds_of_rate(spark):
    df = table(spark, {"is_canceled": 1}, {"is_canceled": None})
    flag = F.col("is_canceled")
    assert G.rate_by_group(df, ["hotel"], flag).first()["cancel_rate"] == 100.0
    assert G.rate_by_group(df, ["hotel"], flag, null_in_denominator=True).first()["cancel_rate"] == 50.0


def test_months_and_bad_names(spark):
    months = "January February March April May June July August September October November December".split()
    df = spark.createDataFrame([(m,) for m in [*months, "Jul", "x", None]], "m string")
    assert [r[0] for r in df.select(month_number(F.col("m"))).collect()] == [*range(1, 13), None, None, None]
    assert df.select(month_text(F.col("m"))).collect()[6][0] == "07"
    seasons = [r[0] for r in df.select(season_of_month(month_number(F.col("m")))).collect()]
    assert seasons[:12] == ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Autumn"] * 3 + ["Winter"]
    assert seasons[12:] == ["Autumn"] * 3


@pytest.mark.parametrize("rate, level", [(36.99, "NORMAL"), (37.0, "ELEVATED"), (50.0, "WARNING"), (60.0, "CRITICAL"), (None, "NORMAL")])
def test_alert_edges(spark, rate, level):
    df = spark.createDataFrame([(rate,)], "r double")
    assert df.select(alert_level(F.col("r"))).first()[0] == level


def test_rounding_ignores_sum_noise(spark):
    values = [(1.015,), (1.0149999999999999,), (-1.015,), (2.5,), (-0.0,), (None,)]
    df = spark.createDataFrame(values, "v double")
    assert [r[0] for r in df.select(stable_round(F.col("v"))).collect()] == [1.02, 1.02, -1.02, 2.5, 0.0, None]


def test_top_n_when_one_group_holds_a_third_of_the_rows(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") < 3000, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 100)).alias("g"), "id"
    )
    top = G.top_n_per_group(df, ["g"], [F.desc("id")], 2)
    assert rows(top.filter("g = 'hot'"), "id") == [(2998,), (2999,)]
    assert top.count() == 202
    assert "WindowGroupLimit" in top._jdf.queryExecution().toString()

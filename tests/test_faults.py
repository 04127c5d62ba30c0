"""Values that test tables rarely hold: nulls, NaN, infinities, neighbours, unlisted groups, empty sources."""

import math

import pytest
from fixtures import bookings
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from staylens import schemas
from staylens.functions import exact_sum, stable_round, units
from staylens.operators import cleaning, groups as G, profile, quantiles, split
from staylens.plans import questions as Q
from staylens.sources import read_bookings
from staylens.streaming import events as E
from staylens.streaming import monitors as M
from staylens.streaming.fanout import SUMMARIES, report
from staylens.streaming.run import replay

NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize("seed", range(1, 8))
def test_split_with_null_and_repeated_keys_has_no_overlap(spark, seed):
    rows = [(None, i % 2) for i in range(5)] + [(i // 2, i % 2) for i in range(20)]
    df = spark.createDataFrame(rows, "k int, t int")
    train, test = split.stratified_split(df, "t", ["k"], seed=seed, method="anti_join")
    sides = [[r["k"] for r in part.collect()] for part in (train, test)]
    assert sum(map(len, sides)) == 25 and not set(sides[0]) & set(sides[1])


def test_rounding_leaves_what_has_no_digits(spark):
    values = [NAN, INF, -INF, 1e17, -1e17, 9.3e12, 2.345, -2.345, None, 0.0]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(stable_round(F.col("x"))).collect()]
    assert math.isnan(got[0]) and got[1:] == [INF, -INF, 1e17, -1e17, 9.3e12, 2.35, -2.35, None, 0.0]
    six = spark.createDataFrame([(9.3e12 + 0.25,)], "x double").select(stable_round(F.col("x"), 6)).first()[0]
    assert six == 9.3e12 + 0.25


@pytest.mark.parametrize("bad", [NAN, INF, -INF, 1e300])
def test_no_amount_is_refused(spark, bad):
    df = spark.createDataFrame([(1.0,), (bad,)], "x double")
    with pytest.raises(PySparkException, match="not an amount"):
        df.select(F.sum(units(F.col("x")))).collect()


def test_sums_are_rounded_and_rows_are_not(spark):
    df = spark.createDataFrame([(0.004,)] * 3, "x double")
    assert float(df.agg(F.round(exact_sum(units(F.col("x"), 6), 6), 2)).first()[0]) == 0.01
    rows = [{"adr": 0.004, "stays_in_week_nights": 1, "stays_in_weekend_nights": 0}] * 3
    assert Q.monthly_revenue(bookings(spark, *rows)).first()["revenue_potential"] == 0.01
    event = spark.createDataFrame([(0.004, "a")] * 5, "v double, k string").withColumn("event_timestamp", F.lit("2020-01-01").cast("timestamp"))
    assert {r["revenue_proxy"] for r in M.sliding_mean(event, ["k"], F.col("v")).collect()} == {0.02}


def test_pivot_keeps_values_nobody_listed(spark):
    df = spark.createDataFrame([("r", "A", 1), ("r", "NEW", 7), ("s", None, 2)], "row string, c string, v bigint")
    got = {r["row"]: r.asDict() for r in G.pivot_matrix(df, ["row"], "c", "v", ["A", "B"], "m").collect()}
    assert got["r"] == {"row": "r", "mA": 1, "mB": 0, "mNEW": 7, "munknown": 0} and got["s"]["munknown"] == 2
    hotels = Q.country_hotel_matrix(bookings(spark, {"hotel": "Third Hotel"}, {}))
    assert "Third Hotel" in hotels.columns
    months = Q.month_year_matrix(bookings(spark, {"arrival_date_month": "Julember"}, {}))
    assert months.agg(F.sum("munknown")).first()[0] > 0


def test_csv_columns_are_found_by_name(spark, tmp_path):
    names = [f.name for f in schemas.RAW.fields]
    row = {f.name: "1" for f in schemas.RAW.fields} | {"adults": "2", "babies": "0", "adr": "5.5", "reservation_status_date": "2016-07-04"}
    swapped = [{"adults": "babies", "babies": "adults"}.get(n, n) for n in names]
    path = tmp_path / "swapped.csv"
    path.write_text(",".join(swapped) + "\n" + ",".join(row[n] for n in swapped) + "\n")
    got = read_bookings(spark, str(path))
    assert got.schema == schemas.RAW and (got.first()["adults"], got.first()["babies"]) == (2, 0)
    path.write_text(",".join(names[1:]) + "\n" + ",".join(row[n] for n in names[1:]) + "\n")
    with pytest.raises(ValueError, match="hotel"):
        read_bookings(spark, str(path))
    path.write_text(",".join(names) + "\n" + ",".join("x" if n == "adults" else row[n] for n in names) + "\n")
    with pytest.raises(PySparkException):
        read_bookings(spark, str(path)).collect()


def quantile(values, p):
    values = sorted(values)
    at = (len(values) - 1) * p
    low, high = values[math.floor(at)], values[math.ceil(at)]
    return low if low == high or at == math.floor(at) else low + (high - low) * (at - math.floor(at))


@pytest.mark.parametrize("values", [
    [1.0 + i * 2.0**-52 for i in range(40)],
    [-INF] * 3 + [INF] * 5 + [1.0, 2.0],
    [5.0] * 400 + [float(i) for i in range(60)],
    [math.ldexp(1.0, -1074) * i for i in range(-20, 20)],
    [-0.0, 0.0, -1e308, 1e308, -1e-308] * 5,
])
def test_narrowing_ends_and_is_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(NAN,), (None,)], "x double")
    got = quantiles.exact_quantiles(df, ["x"], [0.0, 0.25, 0.5, 0.9, 1.0], finish_distinct=2)
    for r in got.collect():
        want = quantile(values, r["probability"])
        assert r["value"] == want or (math.isnan(want) and math.isnan(r["value"])), (r, want)


def test_unreadable_guest_counts_are_reported(spark):
    row = cleaning.clean_counts(bookings(spark, {"children": "two"}, {"children": "NA"}, {})).first()
    assert (row["rows_raw"], row["rows_unreadable"]) == (3, 1)


def test_full_row_duplicates(spark):
    rows = [(1, None, "a|b"), (1, None, "a|b"), (1, None, "\\N"), (1, "\\N", None), (2, "x", ""), (2, "x", None), (2, "x", "")]
    df = spark.createDataFrame(rows, "a int, b string, c string")
    assert {tuple(r) for r in profile.full_row_duplicates(df).collect()} == {(1, None, "a|b", 2), (2, "x", "", 2)}
    assert tuple(profile.full_row_summary(df).first()) == (7, 5, 2, 2)
    assert tuple(profile.full_row_summary(df.limit(0)).first()) == (0, 0, 0, 0)


def test_empty_stream_sources(spark, tmp_path):
    stream = E.read_stream(spark, "parquet", str(tmp_path), "event_timestamp timestamp, hotel string, is_canceled int")
    assert replay(spark, M.bookings_per_minute(stream), ["window_start", "hotel"], "empty").count() == 0
    for name in SUMMARIES:
        assert report(spark, str(tmp_path / "none"), name).count() == 0


def test_full_row_duplicates_meet_by_short_hashes(spark):
    df = spark.createDataFrame(
        [(1, None, 0.5), (1, None, 0.5), (1, "a", None), (None, "a", 0.5), (None, "a", 0.5), (None, "a", 0.5)], "n int, s string, x double"
    )
    got = profile.full_row_duplicates(df)
    plan = got._jdf.queryExecution().executedPlan().toString()
    # No long digest of every row, and the rows are met with a stored table of known size.
    assert "sha2(" not in plan and "Scan parquet" in plan
    assert {tuple(r) for r in got.collect()} == {(1, None, 0.5, 2), (None, "a", 0.5, 3)}
    # Rows that all have one hash, as a map has none.
    maps = spark.sql("SELECT map('k', id % 3) AS m FROM range(5)")
    assert sorted((r["m"]["k"], r["copies"]) for r in profile.full_row_duplicates(maps).collect()) == [(0, 2), (1, 2)]

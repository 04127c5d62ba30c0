import datetime

from fixtures import PLAIN, bookings, rows
from pyspark.sql import functions as F

from staylens import schemas
from staylens.operators import cleaning, features
from staylens.sources import read_bookings, read_features, register, write_csv, write_parquet


def test_children_become_numbers(spark):
    df = bookings(spark, {"children": "NA"}, {"children": None}, {"children": "2"}, {"children": "1.0"}, {"children": "x"})
    assert rows(cleaning.fix_types(df), "children") == [(0,), (0,), (1,), (2,), (None,)]
    assert cleaning.fix_types(cleaning.fix_types(df)).count() == 5


def test_only_guests_without_history_become_new(spark):
    df = bookings(
        spark, {"is_repeated_guest": 1}, {"is_repeated_guest": 1, "previous_cancellations": 1},
        {"is_repeated_guest": None}, {"is_repeated_guest": 1, "previous_bookings_not_canceled": None},
    )
    assert rows(cleaning.correct_flags(df), "is_repeated_guest") == [(0,), (1,), (1,), (None,)]


def test_rules_remove_four_kinds_and_undecided_rows(spark):
    kept = [{}, {"days_in_waiting_list": 99}, {"is_canceled": 1}, {"adr": 0.0}, {"children": "2"}]
    gone = [
        {"adults": 0}, {"adr": -0.01}, {"adults": 0, "babies": 1}, {"adr": None}, {"babies": None},
        {"stays_in_weekend_nights": 0, "stays_in_week_nights": 0, "adr": 0.0},
    ]
    df = cleaning.fix_types(bookings(spark, *kept, *gone))
    assert cleaning.remove_violations(df).count() == len(kept)


def test_caps(spark):
    kept = [{"adr": 4999.99}, {"adults": 4}, {"children": "3"}, {"babies": 3}]
    gone = [{"adr": 5000.0}, {"adults": 5}, {"children": "4"}, {"babies": 4}]
    df = cleaning.fix_types(bookings(spark, *kept, *gone))
    assert cleaning.cap_outliers(df).count() == len(kept)


def test_clean_keeps_copies_and_its_schema(spark):
    df = bookings(spark, {"country": "NULL", "agent": "NA"}, {}, {}, {"adr": 9000.0}, {"adults": 0})
    got = cleaning.clean(df)
    assert [(f.name, f.dataType) for f in got.schema.fields] == [(f.name, f.dataType) for f in schemas.CLEANED.fields]
    assert rows(got, "country", "agent") == [("PRT", "9"), ("PRT", "9"), ("Unknown", "9999")]
    assert rows(cleaning.clean_counts(df)) == [(5, 0, 4, 3)]
    again = cleaning.clean(got.withColumn("company", F.lit("NULL")))
    assert rows(again) == rows(got)


def test_features(spark):
    df = cleaning.clean(
        bookings(
            spark,
            {"previous_cancellations": 1, "previous_bookings_not_canceled": 2, "babies": 1},
            {"stays_in_weekend_nights": 0, "stays_in_week_nights": 0, "adr": 55.5},
        )
    )
    got = features.extract(df)
    assert len(got.columns) == 21
    assert set(got.columns) == {schemas.TARGET, *schemas.CATEGORICAL, *schemas.NUMERIC, *schemas.FLAGS}
    assert rows(got, "total_guests", "total_nights", "total_estimated_cost", "is_family", "cancellation_rate") == [
        (2, 0, 55.5, 0, 0.0), (3, 3, 300.0, 1, 0.25),
    ]


def test_csv_round_trip_keeps_tokens(spark, tmp_path):
    df = bookings(spark, {}, {"country": "NULL", "children": "NA"})
    path = str(tmp_path / "raw.csv")
    write_csv(df, path)
    back = read_bookings(spark, path)
    assert back.schema == schemas.RAW
    assert rows(back) == rows(df)
    assert back.first()["reservation_status_date"] == datetime.date(2016, 7, 4)


def test_parquet_hand_over_and_sql_view(spark, tmp_path):
    path = str(tmp_path / "clean")
    write_parquet(cleaning.clean(bookings(spark, {}, {"hotel": "Resort Hotel"})), path, ("hotel",))
    write_parquet(cleaning.clean(bookings(spark, {})), path, ())
    register(read_features(spark, path))
    assert spark.sql("SELECT hotel, count(*) FROM hotel_bookings GROUP BY hotel").first()[1] == 1
    assert set(read_features(spark, path).columns) == set(PLAIN) - {"company"}

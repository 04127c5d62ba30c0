"""Sketches, index tables, exact splits, CSV folders and repeatable sinks."""

import math
import random

import pytest
from fixtures import rows
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from staylens.ml import index_table
from staylens.operators import sketches, split
from staylens.plans import scale_questions as Q
from staylens.schemas import RAW
from staylens.sources import read_bookings, read_csv_folder, replace_partitions


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_merged_sketches_keep_their_bounds(spark):
    rng = random.Random(1)
    data = [(d, rng.choice([None, float("nan"), rng.gauss(0, 100), 5.0]), rng.randint(0, 4000)) for d in range(40) for _ in range(500)]
    df = spark.createDataFrame(data, "day int, v double, u int")
    stored = sketches.period_sketches(df, {"day": F.col("day")}, {"v": F.col("v")}, {"u": F.col("u")})
    whole = sketches.merged(stored.repartition(7), {"span": F.lit("all")}, ["v"], ["u"])
    row = whole.select(sketches.values_seen("v").alias("n"), sketches.quantiles("v", [0.1, 0.5, 0.9]).alias("q"), sketches.distinct_estimate("u").alias("u")).first()
    values = sorted(v for _, v, _ in data if v is not None and not math.isnan(v))
    assert row["n"] == len(values)
    for p, q in zip((0.1, 0.5, 0.9), row["q"]):
        below, upto = sum(v < q for v in values) / len(values), sum(v <= q for v in values) / len(values)
        assert below - 0.01 <= p <= upto + 0.01
    assert abs(row["u"] - len({u for *_, u in data})) <= 0.04 * len({u for *_, u in data})


def test_positions_are_the_indexers(spark):
    rng = random.Random(2)
    data = [(rng.choice([None, "é", "B", "a", *map(str, range(60))]),) for _ in range(900)]
    df = spark.createDataFrame(data, "c string")
    table = index_table.category_positions(df, ["c"])
    labels = StringIndexer(inputCol="c", outputCol="i", handleInvalid="keep").fit(df).labels
    assert [r["category"] for r in table.orderBy("position").collect()] == list(labels)
    later = spark.createDataFrame([("a",), ("new",), (None,)], "c string")
    got = {r["c"]: r["c_idx"] for r in index_table.with_positions(later, table, ["c"]).collect()}
    assert got == {"a": labels.index("a"), "new": len(labels), None: len(labels)}


def test_very_many_categories_never_reach_the_driver(spark):
    """A million categories: the table is counted, numbered and joined by tasks."""
    df = spark.range(1_000_000).select((F.col("id") % 700_000).cast("string").alias("c"))
    table = index_table.category_positions(df, ["c"])
    assert table.agg(F.count("*"), F.min("position"), F.max("position"), F.countDistinct("position")).first()[:] == (700_000, 0, 699_999, 700_000)
    first = table.filter("n = 2").agg(F.max("position")).first()[0]
    assert first == 299_999
    hashed = index_table.hashed_features(df.limit(5), ["c"], size=64)
    assert all(r["hashed"].size == 64 and sum(r["hashed"].values) == 1 for r in hashed.collect())


@pytest.mark.parametrize("share", [0.8, 0.0, 1.0, 0.333])
def test_exact_split_gives_each_class_its_share(spark, share):
    data = [("a", i) for i in range(1003)] + [("b", i) for i in range(7)] + [(None, i) for i in range(50)] + [("c", 1)] * 301
    df = spark.createDataFrame(data, "y string, id int").withColumn("class", F.lit("x")).repartition(4)
    tagged = split.exact_split(df, "y", ["id"], share, fractions={"b": 0.5})
    assert tagged.columns == [*df.columns, "dataset"] and tagged.count() == len(data)
    got = {r["y"]: r["n"] for r in tagged.groupBy("y").agg(F.count_if(F.col("dataset") == "Train").alias("n")).collect()}
    assert got == {y: math.floor(n * (0.5 if y == "b" else share) + 0.5) for y, n in (("a", 1003), ("b", 7), (None, 50), ("c", 301))}
    again = split.exact_split(df.repartition(3), "y", ["id"], share, fractions={"b": 0.5})
    assert rows(tagged.filter("y <> 'c'"), "y", "id", "dataset") == rows(again.filter("y <> 'c'"), "y", "id", "dataset")


def test_exact_split_of_an_empty_table(spark):
    assert split.exact_split(spark.createDataFrame([], "y string, id int"), "y", ["id"]).count() == 0


CSV = StructType([StructField("adults", IntegerType()), StructField("babies", IntegerType()), StructField("day", DateType()), StructField("note", StringType())])


def write(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, lines in files.items():
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    write(
        tmp_path / "in",
        one=["adults,babies,day,note", "2,0,2024-01-01,x", '1,1,2024-01-02,"a, b"'],
        two=["note,day,extra,babies,adults", "y,2024-01-03,9,3,4", ",2024-01-04,9,,5"],
        bad=["babies,adults,note,day", "1,two,n,2024-01-05", "1,2,n,2024-01-05,more", "1", "0,7,ok,2024-01-06", "1,2,n,someday"],
    )
    got = read_csv_folder(spark, str(tmp_path / "in"), CSV)
    assert rows(got.good.select("adults", "babies", "note"), "adults", "babies", "note") == [(1, 1, "a, b"), (2, 0, "x"), (4, 3, "y"), (5, None, None), (7, 0, "ok")]
    bad = [(r["file"].rsplit("/", 1)[1], r["reason"]) for r in got.bad.collect()]
    assert sorted(bad) == [("bad.csv", "malformed"), ("bad.csv", "malformed"), ("bad.csv", "mistyped adults"), ("bad.csv", "mistyped day")]
    assert {r["record"] for r in got.bad.collect()} == {"1,two,n,2024-01-05", "1,2,n,2024-01-05,more", "1", "1,2,n,someday"}


def test_files_without_a_header_are_named(spark, tmp_path):
    write(tmp_path / "in", one=["adults,babies,day,note", "2,0,2024-01-01,x"], two=["adults,day", "1,2024-01-01"])
    with pytest.raises(ValueError, match="two.csv"):
        read_csv_folder(spark, str(tmp_path / "in"), CSV)


def test_strict_reader_refuses_mixed_headers(spark, tmp_path):
    schema = StructType([f for f in RAW.fields if f.name in ("adults", "babies")])
    write(tmp_path / "in", one=["adults,babies", "2,0"], two=["babies,adults", "0,2"])
    with pytest.raises(Exception):
        read_bookings(spark, str(tmp_path / "in"), schema).collect()
    write(tmp_path / "same", one=["babies,adults", "0,2"], two=["babies,adults", "0,2"])
    assert [tuple(r) for r in read_bookings(spark, str(tmp_path / "same"), schema).select("adults", "babies").collect()] == [(2, 0)] * 2


def test_a_rerun_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_partitions(spark.range(100).selectExpr("id", "id % 4 AS part"), path, ("part",))
    replace_partitions(spark.range(5).selectExpr("id + 1000 AS id", "2L AS part"), path, ("part",))
    counts = spark.read.parquet(path).groupBy("part").count()
    assert rows(counts, "part", "count") == [(0, 25), (1, 25), (2, 5), (3, 25)]


def test_bucketed_tables_join_without_a_shuffle(spark, small):
    orders, lines = Q.bucketed_orders(spark, small)
    joined = orders.hint("merge").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    assert "Exchange" not in plan(joined)
    assert "Exchange" not in plan(lines.groupBy("l_orderkey").count())


def test_csv_records_are_made_of_bad_rows_only(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,name\n1,a\n2,b\nx,c\n")
    (tmp_path / "in" / "empty.csv").write_text("")
    got = read_csv_folder(spark, str(tmp_path / "in"), spark.createDataFrame([], "id int, name string").schema)
    stored = spark.read.parquet(*got.good.inputFiles())
    assert sorted(tuple(r) for r in got.good.collect()) == [(1, "a"), (2, "b")]
    assert [r["record"] for r in got.bad.collect()] == ["x,c"]
    assert sorted(r["record"] or "" for r in stored.collect()) == ["", "", "x,c"]

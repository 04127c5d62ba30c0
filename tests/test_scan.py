import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from staylens.operators import scan

SCHEMA = "g string, x int, v bigint"


@pytest.fixture(scope="module")
def table(spark):
    """A third of the rows in one group, a third equal in all columns, and null keys and values."""
    rng = random.Random(5)
    data = [("hot", i % 700, rng.randint(-5, 9)) for i in range(3000)] + [("same", 7, 1)] * 3000
    data += [(rng.choice([None, "a", "b", *map(str, range(300))]), rng.choice([None, *range(9)]), rng.randint(0, 9)) for _ in range(3000)]
    rng.shuffle(data)
    # Small ranges, so that groups lie in several.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark.createDataFrame(data, SCHEMA).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def same(a, b):
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_running_totals_equal_the_plain_window(spark, table):
    one = table.groupBy("g", "x").agg(F.sum("v").alias("v"))
    got = scan.running_totals(one, ["g"], ["-x"], {"upto": F.col("v"), "n": F.lit(1)})
    w = Window.partitionBy("g").orderBy(F.desc("x")).rowsBetween(Window.unboundedPreceding, 0)
    same(got, one.withColumns({"upto": F.sum("v").over(w), "n": F.row_number().over(w).cast("bigint")}))
    whole = scan.running_totals(one, [], ["g", "x"], {"upto": F.col("v")})
    w = Window.orderBy("g", "x").rowsBetween(Window.unboundedPreceding, 0)
    same(whole, one.withColumn("upto", F.sum("v").over(w)))


def test_equal_rows_are_numbered_without_gaps(spark, table):
    got = scan.running_totals(table, ["g"], ["x"], {"n": F.lit(1)})
    assert got.count() == 9000
    wrong = got.groupBy("g").agg(F.count("*").alias("c"), F.countDistinct("n").alias("d"), F.max("n").alias("m"))
    assert wrong.filter("c <> d OR c <> m").count() == 0


def test_no_task_holds_a_hot_group(spark, table):
    rows = scan._in_ranges(table, ["g"], ["x"])
    sizes = [r["count"] for r in rows.groupBy("_scan_block").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 2 * 9000 / len(sizes)


def test_previous_value_equals_lag(spark, table):
    one = table.groupBy("g", "x").agg(F.sum("v").alias("v"))
    for order, w in ((["x"], Window.partitionBy("g").orderBy("x")), (["-x"], Window.partitionBy("g").orderBy(F.desc("x")))):
        same(scan.previous_value(one, ["g"], order, "v", "before"), one.withColumn("before", F.lag("v").over(w)))
    same(scan.previous_value(one, [], ["g", "x"], "v", "p"), one.withColumn("p", F.lag("v").over(Window.orderBy("g", "x"))))


def test_ranks_equal_the_plain_window(spark, table):
    w = Window.partitionBy("g").orderBy(F.desc("v"))
    want = table.withColumns({"rank": F.rank().over(w).cast("bigint"), "dense": F.dense_rank().over(w).cast("bigint")})
    same(scan.ranks(table, ["g"], ["-v"], "rank", "dense"), want)
    w = Window.orderBy("x")
    same(scan.ranks(table, [], ["x"]), table.withColumn("rank", F.rank().over(w).cast("bigint")))


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert scan.running_totals(empty, ["g"], ["x"], {"n": F.lit(1)}).count() == 0
    assert scan.previous_value(empty, [], ["x"], "v", "p").count() == 0
    assert scan.ranks(empty, ["g"], ["x"]).count() == 0

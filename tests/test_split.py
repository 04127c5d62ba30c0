import pytest
from fixtures import rows
from pyspark.sql import functions as F

from staylens.operators import joins, split


@pytest.fixture(scope="module")
def people(spark):
    return spark.range(20_000).select("id", (F.col("id") % 10 < 3).cast("int").alias("label"))


def test_parts_are_disjoint_whole_and_stable(spark, people):
    train, test = split.stratified_split(people, "label", ["id"])
    again, _ = split.stratified_split(people.repartition(5, F.rand(1)), "label", ["id"])
    assert rows(train) == rows(again)
    assert train.join(test, "id").count() == 0
    assert train.count() + test.count() == people.count()


def test_share_holds_in_every_class(people):
    report = split.balance_report(split.tag_split(people, ["id"]), "label").collect()
    counts = {(r["dataset"], r["label"]): r["count"] for r in report}
    for label in (0, 1):
        share = counts[("Train", label)] / (counts[("Train", label)] + counts[("Test", label)])
        assert abs(share - 0.8) < 0.015
    for name in ("Train", "Test"):
        assert sum(r["percentage"] for r in report if r["dataset"] == name) == pytest.approx(100, abs=0.02)


def test_anti_join_form_gives_the_same_parts(people):
    _, test = split.stratified_split(people, "label", ["id"])
    _, other = split.stratified_split(people, "label", ["id"], method="anti_join")
    assert rows(test) == rows(other)
    with pytest.raises(ValueError):
        split.stratified_split(people, "label", method="anti_join")


def test_class_fractions(people):
    tagged = split.tag_split(people, ["id"], fractions={0: 0.5, 1: 1.0}, target="label")
    counts = {(r["dataset"], r["label"]): r["count"] for r in split.balance_report(tagged, "label").collect()}
    assert ("Test", 1) not in counts and abs(counts[("Train", 0)] / 14_000 - 0.5) < 0.02


def test_copies_without_a_key_stay_together(spark):
    df = spark.range(3000).select((F.col("id") % 50).alias("a"), F.lit(1).alias("label"))
    tagged = split.tag_split(df)
    assert tagged.select("a", "dataset").distinct().count() == 50


def test_seed_changes_the_parts(people):
    first = split.stratified_split(people, "label", ["id"], seed=1)[0]
    other = split.stratified_split(people, "label", ["id"], seed=2)[0]
    assert rows(first) != rows(other)


def test_anti_join_with_a_hot_key_and_nulls(spark):
    left = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k long")
    right = spark.range(3000).select(F.when(F.col("id") < 1000, 1).otherwise(F.col("id")).alias("k"))
    assert rows(joins.anti_join(left, right.filter("k = 1"), ["k"])) == [(2,), (3,), (None,)]

import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from staylens.llm import mixing as M

SCHEMA = "doc_id bigint, text string, source string"


def fill(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Share by weight, stop at the cap, share the excess again: the plain loop."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, target, free = share * sum(sizes.values()), dict.fromkeys(order, 0.0), list(order)
    while free and left > 1e-9:
        unit, left = left / sum(weight[s] for s in free), 0.0
        for s in free:
            target[s] += unit * weight[s]
            if target[s] > most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
        free = [s for s in free if target[s] < most * sizes[s]]
    return target


def rows_of(df, **options):
    rows, names = M.with_takes(df, keep=["doc_id"], **options)
    return rows.select("doc_id", *[F.col(names[n]).alias(n) for n in ("size", "source_size", "target", "takes")]).collect()


def corpus(n=3000, seed=3):
    rng = random.Random(seed)
    sources = [None, "a", "b", "c", "Z", "é"]
    return [(i, " ".join("w" * rng.randint(1, 5) for _ in range(rng.randint(0, 30))), sources[min(5, int(rng.expovariate(0.8)))]) for i in range(n)]


def test_targets_and_takes(spark):
    data = corpus()
    sizes, source = defaultdict(int), {}
    for i, text, s in data:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", text))
        source[i] = s
    want = fill(sizes)
    taken = defaultdict(int)
    for r in rows_of(spark.createDataFrame(data, SCHEMA)):
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6
        assert r["takes"] in (0, 1, 2)
        taken[s] += r["takes"] * r["size"]
    assert all(abs(taken[s] - want[s]) <= 30 for s in sizes)  # within one document


def test_reruns_agree_and_budgets_nest(spark):
    df = spark.createDataFrame(corpus(), SCHEMA)
    one = {r["doc_id"]: r["takes"] for r in rows_of(df)}
    assert one == {r["doc_id"]: r["takes"] for r in rows_of(df.repartition(7))}
    more = {r["doc_id"]: r["takes"] for r in rows_of(df, share=1.8)}
    assert all(more[i] >= one[i] for i in one)


def test_one_hot_source_with_equal_texts(spark):
    data = [(i, "same words in all of them", "hot") for i in range(2000)] + [(5000 + i, "few", f"s{i}") for i in range(3)]
    rows = rows_of(spark.createDataFrame(data, SCHEMA))
    hot = [r for r in rows if r["doc_id"] < 5000]
    assert abs(sum(r["takes"] * r["size"] for r in hot) - hot[0]["target"]) <= 5


def test_nulls_empty_texts_and_repeated_rows(spark):
    data = [(None, None, None), (1, "", "a"), (2, None, "a"), (3, "x y", "b"), (3, "x y", "b"), (None, "z", None), (4, "l " * 300_000, "b")]
    rows = rows_of(spark.createDataFrame(data, SCHEMA))
    assert len(rows) == 7 and sorted(r["size"] for r in rows) == [0, 0, 0, 1, 2, 2, 300_000]
    assert all(r["target"] == 0 and r["takes"] == 0 for r in rows if r["source_size"] == 0)
    assert rows_of(spark.createDataFrame([], SCHEMA)) == []


def test_mixed_keeps_columns_and_repeats(spark):
    df = spark.createDataFrame(corpus(400), SCHEMA).withColumn("size", F.lit("clash")).withColumn("takes", F.lit(1)).withColumn("target", F.lit(2))
    out = M.mixed(df)
    assert out.columns == df.columns
    copies = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert copies == {r["doc_id"]: r["takes"] for r in rows_of(df.select("doc_id", "text", "source")) if r["takes"]}
    assert M.mixed(df.limit(0)).count() == 0


def test_half_of_a_source_are_equal_rows(spark):
    """Equal in id and text, so they share a hash: they are parted all the same."""
    rng = random.Random(7)
    data = [(1, " ".join(["w"] * 20), "hot")] * 500 + [(10 + i, "w " * rng.randint(1, 9), "hot") for i in range(500)]
    data += [(5000 + i, "v " * 30, s) for i, s in enumerate(["a", "b"] * 400)] + [(None, None, None)] * 300 + [(None, "x y", None)] * 300
    df = spark.createDataFrame(data, SCHEMA)
    for share in (0.4, 0.9, 1.5):
        sums, target = defaultdict(int), {}
        rows, names = M.with_takes(df, keep=["doc_id", "source"], share=share)
        for r in rows.collect():
            sums[r["source"]] += r[names["takes"]] * r[names["size"]]
            target[r["source"]] = r[names["target"]]
        assert all(abs(sums[s] - target[s]) <= 20 for s in target), (sums, target)
        assert len(target) == 4


def test_very_many_sources(spark):
    df = spark.range(20_000).selectExpr("id AS doc_id", "repeat('w ', CAST(id % 7 AS INT)) AS text", "CAST(id % 6000 AS STRING) AS source")
    rows = rows_of(df)
    sizes = {}
    for i in range(20_000):
        sizes[str(i % 6000)] = sizes.get(str(i % 6000), 0) + i % 7
    want, got = fill(sizes), {}
    for r in rows:
        got[str(r["doc_id"] % 6000)] = r["target"]
    assert all(abs(got[s] - want[s]) < 1e-6 for s in sizes)

import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from staylens.llm import queries
from staylens.llm import sampled_splitters as P

SCHEMA = "doc_id bigint, text string"


def check(rows, data, shards, tolerance):
    assert len(rows) == len(data)
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r)
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    sizes = [sum(r["size"] for r in by[s]) for s in range(shards)]
    mean = sum(sizes) / shards
    assert max(abs(s - mean) for s in sizes) <= tolerance * mean, sizes
    want = sorted((i is None, i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in data)
    assert sorted((r["doc_id"] is None, r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    return by


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op10_shard_by_bytes(spark, "/root/testdata/sf0.01").collect()
    check(rows, [tuple(d) for d in docs], 8, 0.05)
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}
    again = queries.op10_shard_by_bytes(spark, "/root/testdata/sf0.01").collect()
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in rows} == {(r["doc_id"], r["shard"], r["slot"]) for r in again}


def test_hot_group_is_subdivided(spark):
    rng = random.Random(1)
    data = [(i, "one text that a third of all rows share") for i in range(3000)] + [(3000 + i, "x" * rng.randint(0, 120)) for i in range(6000)]
    by = check(P.sharded(spark.createDataFrame(data, SCHEMA), 8).collect(), data, 8, 0.02)
    assert sum(any(r["size"] == 40 and r["text_crc32"] == zlib.crc32(data[0][1].encode()) for r in own) for own in by.values()) >= 2


def test_overfull_ranges_are_found_where_the_sample_was_poor(spark):
    keyed = spark.range(20_000).select(F.xxhash64("id").alias("k"), F.xxhash64("id", F.lit(1)).alias("d"), F.lit(3).cast("bigint").alias("size"))
    splitters, size, count = P.find_splitters(keyed, 200, samples=1)
    assert size.sum() == 60_000 and count.sum() == 20_000 and splitters == sorted(splitters)
    assert size.max() <= P.OVERFULL * 300


def test_nulls_long_texts_ties_and_few_rows(spark):
    data = [(None, None), (None, "a"), (1, ""), (1, ""), (2, "b" * 3_000_000), (3, "é")]
    rows = P.sharded(spark.createDataFrame(data, SCHEMA).withColumn("size", F.lit("x")).withColumn("range", F.lit(1)), 4).collect()
    check(rows, data, 4, 10)
    assert {r["size"] for r in rows if r["doc_id"] is None} == {1, 2}
    assert P.sharded(spark.createDataFrame([], SCHEMA), 4).count() == 0
    same = [(7, "t")] * 500  # nothing tells these rows apart
    check(P.sharded(spark.createDataFrame(same, SCHEMA), 4).collect(), same, 4, 10)


def test_a_third_of_all_rows_are_equal(spark):
    """Equal in id and text, so that only their number can part them: the law holds all the same."""
    rng = random.Random(6)
    for key, text in ((None, "z" * 1000), (3, None)):
        data = [(key, text)] * 1000 + [(10 + i, "x" * rng.randint(0, 1500)) for i in range(2000)]
        by = check(P.sharded(spark.createDataFrame(data, SCHEMA).repartition(5), 8).collect(), data, 8, 0.02)
        assert sorted(by) == list(range(8))


def test_a_hot_key_beside_few_others(spark):
    data = [(1, "same")] * 3000 + [(2, "same")] * 40 + [(i, f"t{i}") for i in range(50)]
    # A shard may be off by half a range at either end.
    check(P.sharded(spark.createDataFrame(data, SCHEMA), 8, ranges_per_shard=16).collect(), data, 8, 1 / 16)
    large = [(1, "l" * 100_000), (2, "s"), (3, "t"), (3, "t")]
    assert len(P.sharded(spark.createDataFrame(large, SCHEMA), 3).collect()) == 4

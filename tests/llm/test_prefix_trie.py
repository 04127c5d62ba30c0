import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from staylens.llm import prefix_trie as T

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(data):
    """Every prefix of every rebuilt conversation in a dictionary."""
    own = defaultdict(list)
    for c, turn, role, text in data:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), (role or "").encode(), hashlib.sha256((text or "").encode()).hexdigest(), role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        lender = c - int(np.fmod(c, 5))
        full[c] = own.get(lender, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c in sorted(full):
        for d in range(len(full[c]) + 1):
            members[tuple(full[c][:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        below = children[p]
        leaves[p] = sum(leaves[x] for x in below) if below else 1
        worth = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        saved[p] = worth + sum(saved[x] for x in below)
        ends = ",".join(str(c) for c in members[p] if len(full[c]) == len(p))
        out.append((
            members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]), len(below), leaves[p], saved[p],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def found(spark, data, **options):
    return rows_of(T.conversation_trie(spark.createDataFrame(data, SCHEMA).repartition(3), **options))


def corpus(n=80, seed=1):
    rng = random.Random(seed)
    data = []
    for c in range(n):
        if rng.random() < 0.9:
            for t in range(rng.randint(1, 14)):
                text = rng.choice(["same", "Süß", "yes", ""]) if rng.random() < 0.7 else f"words {rng.random()}"
                data.append((c, t, rng.choice(["user", "assistant"]) if rng.random() < 0.2 else "user", text))
    return data


def test_equals_the_plain_trie(spark):
    for seed in (1, 2):
        data = corpus(seed=seed)
        assert found(spark, data) == plain(data)


def test_a_tiny_sketch_changes_no_result(spark):
    data = corpus(seed=3)
    assert found(spark, data, width=8) == found(spark, data) == plain(data)


def test_estimate_of_one_proves_a_singleton(spark):
    turns, _ = T.rebuilt(T.numbered_turns(spark.createDataFrame(corpus(200, 4), SCHEMA)))
    rows = T.prefixes(turns).cache()
    for width in (64, 1 << 16):
        flagged = T.screened(rows, T.shared_counters(rows, width), width)
        shared = flagged.groupBy("p0", "p1", "depth").agg(F.count("*").alias("n"), F.max("alone").alias("alone"))
        assert shared.filter("n > 1 AND alone").count() == 0
        if width > 64:
            singles = shared.filter("n = 1")
            assert singles.filter("alone").count() > 0.9 * singles.count()


def test_widths_grow_up_to_the_bound():
    assert T.sketch_width(0) == T.LEAST_WIDTH and T.sketch_width(10**6) == 1 << 21
    assert T.sketch_width(10**15) == T.WIDTH


def test_copies_of_one_conversation_and_a_hot_long_one(spark, monkeypatch):
    monkeypatch.setattr(T, "CHUNK", 7)
    data = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(3)] + [(1000, t, "user", f"t{t % 3}") for t in range(1500)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(spark, data) == plain(data)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_nulls_ties_repeats_negative_ids_and_clashes(spark):
    data = [(None, 0, "user", "x"), (5, None, None, None), (5, None, "user", "b"), (5, 1, "a", "t"), (5, 1, "a", "t"), (5, 1, "Z", "t")]
    data += [(-7, i, "u", "v" * i) for i in range(12)] + [(-5, i, "u", "é" * i) for i in range(12)] + [(6, 0, "u", ""), (9, 3, "u", "l" * 500_000)]
    df = spark.createDataFrame(data, SCHEMA).withColumns({"depth": F.lit(1), "p0": F.lit("x"), "conv": F.lit(9), "place": F.lit(None)})
    assert rows_of(T.conversation_trie(df)) == plain(data)


def test_empty_table_and_one_turn(spark):
    assert found(spark, []) == []
    assert found(spark, [(3, 0, "user", "only")]) == plain([(3, 0, "user", "only")])

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from staylens.llm import line_filters as L
from staylens.llm import queries

SCHEMA = "doc_id bigint, text string"
BLANK = " \t\n\x0b\x0c\r"
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def key(line):
    return line.strip(BLANK).translate(LOW)


def holders(data):
    out = defaultdict(set)
    for i, text in data:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                out[key(line)].add(-1 if i is None else i)
    return out


def plain(data, index=None, least=3):
    """(id, lines, dropped, text) of every row, judged by the documents of ``index``."""
    held = holders(data if index is None else index)
    out = []
    for i, text in data:
        lines = (text or "").split("\n")
        gone = [len(held.get(key(x), ())) >= least and max(held[key(x)]) != (-1 if i is None else i) for x in lines]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(out, key=repr)


def rows_of(found):
    df, names = found
    return sorted((tuple(r) for r in df.select("doc_id", names["n_lines"], names["n_dropped"], names["kept_text"]).collect()), key=repr)


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def corpus(n=300, seed=1, first=0):
    rng = random.Random(seed)
    common = ["All rights reserved by the owner", "  subscribe to our NEWSLETTER today\t", "short", "Ünïcode líne wíth ÄÖÜ and more", "", "x" * 19, "x" * 20]
    shapes = [lambda s: s, str.upper, lambda s: f" {s}\r", lambda s: s + "\x0b"]

    def line():
        return rng.choice(shapes)(rng.choice(common)) if rng.random() < 0.4 else f"own line number {rng.randint(0, 4 * n)} of the text"

    return [(first + i, "\n".join(line() for _ in range(rng.randint(0, 9)))) for i in range(n)]


def test_equals_the_plain_rule(spark):
    data = corpus()
    assert rows_of(L.deduplicated(frame(spark, data))) == plain(data)


def test_query_has_the_digest_of_the_kept_text(spark, small):
    data = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in queries.op12_line_dedup(spark, small).collect())
    assert got == sorted((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in plain(data))


def test_insertions_and_deletions_are_reversible(spark, tmp_path):
    one, two = corpus(120, 1), corpus(120, 2, first=500)
    index = L.create(spark, str(tmp_path / "index"), shards=3)
    index = L.insert(index, frame(spark, one))
    after_one = {r["shard"]: bytes(r["marks"]) for r in index.filters().collect()}
    assert rows_of(L.cleaned(index, frame(spark, one))) == plain(one)
    index = L.insert(index, frame(spark, two))
    everything = one + two
    assert rows_of(L.cleaned(index, frame(spark, everything))) == plain(everything)
    gone = [(i,) for i, _ in two] + [(99_999,)]
    index = L.delete(index, spark.createDataFrame(gone, "doc_id bigint"))
    assert rows_of(L.cleaned(index, frame(spark, one))) == plain(one)
    held = {r["key"]: (r["n_docs"], r["top_doc"]) for r in index.counts().collect()}
    want = {hashlib.sha256(k.encode()).digest()[:16]: (len(v), max(v)) for k, v in holders(one).items()}
    assert {bytes(k): v for k, v in held.items()} == want

    def marks(packed):
        return sorted(x for x in np.frombuffer(packed, np.uint16).tolist() if x)

    now = {r["shard"]: bytes(r["marks"]) for r in index.filters().collect()}
    assert {s: marks(m) for s, m in now.items() if marks(m)} == {s: marks(m) for s, m in after_one.items() if marks(m)}
    # The largest holder of each line goes: the next largest keeps it.
    half = [(i, t) for i, t in one if i < 60]
    index = L.delete(index, spark.createDataFrame([(i,) for i, _ in one if i >= 60], "doc_id bigint"))
    assert rows_of(L.cleaned(index, frame(spark, half))) == plain(half)


def test_documents_outside_the_index_are_judged_by_it(spark, tmp_path):
    one, other = corpus(100, 5), corpus(50, 6, first=-60)
    index = L.insert(L.create(spark, str(tmp_path / "index")), frame(spark, one))
    assert rows_of(L.cleaned(index, frame(spark, other))) == plain(other, index=one)


def test_an_operation_counts_once_it_is_whole(spark, tmp_path):
    one = corpus(60, 7)
    index = L.insert(L.create(spark, str(tmp_path / "index"), min_docs=2, shards=2), frame(spark, one))
    # A driver that was lost on its way: references, but neither filters nor the operation's row.
    torn = spark.createDataFrame([(0, b"0" * 16, 5, 1)], "shard int, key binary, doc bigint, change bigint")
    torn.write.parquet(str(tmp_path / "index/references/operation=2"))
    again = L.open_index(spark, str(tmp_path / "index"))
    assert again == index and again.counts().filter(F.col("key") == F.lit(bytearray(b"0" * 16))).count() == 0
    again = L.insert(again, frame(spark, corpus(60, 8, first=100)))
    both = one + corpus(60, 8, first=100)
    assert rows_of(L.cleaned(again, frame(spark, both))) == plain(both, least=2)


def test_documents_inserted_twice_count_once(spark, tmp_path):
    data = [(1, "the very same line of text"), (2, "the very same line of text")]
    index = L.create(spark, str(tmp_path / "index"))
    for _ in range(3):
        index = L.insert(index, frame(spark, data))
    assert [r["n_docs"] for r in index.counts().collect()] == [2]
    index = L.delete(index, frame(spark, data[:1]))
    assert [(r["n_docs"], r["top_doc"]) for r in index.counts().collect()] == [(1, 2)]


def test_cuckoo_tables_lose_nothing(monkeypatch):
    monkeypatch.setattr(L, "BUCKETS", 16)
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 1 << 63, (900, 2)).astype(np.uint64)
    tables = L.CuckooTables()
    tables.add(keys[:600])
    assert len(tables.tables) > 5 and tables.holds(keys[:600]).all()
    tables.take_out(keys[:300])
    assert tables.holds(keys[300:600]).all()
    tables = L.CuckooTables(tables.pack())
    tables.add(keys[600:])
    assert tables.holds(keys[300:]).all()
    tables.take_out(keys[300:])
    assert not any(t.any() for t in tables.tables) and not tables.holds(keys).any()


def test_probe_misses_most_lines(spark, tmp_path):
    data = [(i, f"a line that only document {i} has") for i in range(2000)] + [(i, "a line that all of these have") for i in range(9)]
    index = L.insert(L.create(spark, str(tmp_path / "index")), frame(spark, data))
    hits = L.probed(index, L.lines_of(frame(spark, data)))
    assert 9 <= hits.count() <= 20


def test_hot_line_repeats_nulls_long_texts_and_clashes(spark):
    hot = "this line is in a third of all documents"
    data = [(i, f"{hot}\nand a line of its own {i}") for i in range(1000)] + [(None, hot)] * 500 + [(None, None), (None, ""), (7, ""), (7, hot), (7, hot)]
    data += [(2000, "\n".join([hot, "repeated line within one text"] * 20_000)), (1999, "repeated line within one text")]
    df = frame(spark, data).withColumns({"n_lines": F.lit(1), "KEPT_TEXT": F.lit("x"), "shard": F.lit(1), "key": F.lit(2), "doc": F.lit(3)})
    found, names = L.deduplicated(df)
    assert names["kept_text"] == "kept_text_" and found.columns[:7] == df.columns
    assert rows_of((found, names)) == plain(data)


@pytest.mark.parametrize("kind", ["string", "int"])
def test_other_ids_and_empty_tables(spark, kind):
    data = [(i, "shared line of twenty and more") for i in range(5)]
    df = frame(spark, data).withColumn("doc_id", F.col("doc_id").cast(kind))
    got = rows_of(L.deduplicated(df))
    assert [(str(i), d) for i, _, d, _ in got] == [(str(i), int(i < 4)) for i in range(5)]
    assert L.deduplicated(spark.createDataFrame([], SCHEMA))[0].count() == 0

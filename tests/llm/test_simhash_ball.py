import random
import re

import xxhash
from pyspark.sql import functions as F

from staylens.llm import queries
from staylens.llm import simhash_ball as S

SCHEMA = "doc_id bigint, text string"


def plain_print(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest id reachable over all pairs within three bits, by union-find."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_fingerprints_of_the_contract():
    for text in ("A b C", "one", "a b", "The quick\tbrown fox\x0bjumps over  the lazy dog " * 3, "É é Ü x y\x85z", "", None, "a a a a a a", "x " * 5000):
        got = S.fingerprint(text.encode() if text is not None else None) & (1 << 64) - 1
        assert got == plain_print(text), text


def test_every_pair_within_the_radius_is_connected(spark):
    rng = random.Random(5)
    prints = []
    for _ in range(60):
        base = rng.getrandbits(64)
        prints.append(base)
        for bits in (1, 2, 3, 3, 3, 4, 5):
            p = rng.choice(prints[-3:])
            for b in rng.sample(range(64), bits):
                p ^= 1 << b
            prints.append(p)
    prints += [0, 1, 7, (1 << 64) - 1]
    prints = list(dict.fromkeys(prints))
    rng.shuffle(prints)
    frame = spark.createDataFrame([(S._signed(p),) for p in prints], "fp bigint")
    edges = {(r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1) for r in S.links(frame).collect()}
    assert all((a ^ b).bit_count() <= 3 for a, b in edges)
    roots = {r["node"]: r["root"] for r in S.contract(S.links(frame)).collect()}
    mine = [roots.get(S._signed(p), S._signed(p)) for p in prints]
    want = plain_components(prints)
    assert len(set(zip(mine, want))) == len(set(mine)) == len(set(want))


def test_dense_ball_gives_few_links(spark):
    """A thousand fingerprints within two bits of one another: linked, but not as all pairs."""
    masks = [0, *(1 << i for i in range(64)), *(1 << i | 1 << j for i in range(40) for j in range(i))][:800]
    frame = spark.createDataFrame([(S._signed(0x0F0F00FF12345678 ^ m),) for m in masks], "fp bigint")
    links = S.links(frame)
    assert links.count() < 800 * 70
    assert S.contract(links).select("root").distinct().count() == 1


def test_long_chain_contracts(spark):
    edges = spark.createDataFrame([(i * 7919 % 1009, (i + 1) * 7919 % 1009) for i in range(1008)], "a bigint, b bigint")
    assert [r["root"] for r in S.contract(edges).select("root").distinct().collect()] == [0]
    assert S.contract(edges.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()
    prints = [plain_print(d["text"]) for d in docs]
    want = {d["doc_id"]: (f"{p:016x}", docs[c]["doc_id"]) for d, p, c in zip(docs, prints, plain_components(prints))}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op5_simhash_components(spark, "/root/testdata/sf0.01").collect()}
    assert got == want
    assert len({c for _, c in want.values()}) < len(want)  # there are near copies to find


def test_deduplicated_edge_cases(spark):
    text = " ".join(f"word{i}" for i in range(400))
    near = text.replace("word200", "other")
    rows = [(3, text), (1, near), (2, text), (2, text), (None, text), (7, None), (6, ""), (None, ""), (9, "quite another text of its own"), (9, "quite another text of its own")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("fp", F.lit("x")).withColumn("_key", F.lit(1)).withColumn("root", F.lit(2))
    out = S.deduplicated(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == [(1, near), (6, ""), (9, "quite another text of its own")]
    assert S.deduplicated(df.limit(0)).count() == 0
    ids = {(r["doc_id"], r["component_id"]) for r in S.components(df.select("doc_id", "text")).collect()}
    assert (None, 1) in ids and (None, 6) in ids
    only = S.components(spark.createDataFrame([(None, "a b c")], SCHEMA)).collect()
    assert [(r["doc_id"], r["component_id"]) for r in only] == [(None, None)]

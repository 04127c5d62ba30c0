import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from staylens.llm import mixing, queries, template_leaks
from staylens.llm.simhash_ball import fingerprint

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's result, kept as a table."""
    docs, out = queries.table(spark, FOLDER, "documents"), {}
    out["documents"] = docs
    for name, stage in P.STAGES:
        docs = P.written(stage(spark, docs, FOLDER), "test-stage")
        out[name] = docs
    return out


def test_stages_in_order_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "source_mixing", "token_records"]
    for name, _ in P.STAGES[:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_language_stage_keeps_clean_documents(stages):
    assert stages["language_id"].count() == stages["documents"].count()


def test_dedup_leaves_no_pair_and_one_of_each_group(stages):
    before, after = stages["language_id"].collect(), stages["simhash_near_dedup"].collect()
    kept = {d["doc_id"] for d in after}
    prints = {d["doc_id"]: fingerprint(d["text"].encode()) & (1 << 64) - 1 for d in before}
    ids = sorted(kept)
    assert not [(a, b) for i, a in enumerate(ids) for b in ids[:i] if (prints[a] ^ prints[b]).bit_count() <= 3]
    reached = set(kept)
    for _ in range(30):  # every dropped document hangs on a kept one
        reached |= {d for d in prints if d not in reached and any((prints[d] ^ prints[k]).bit_count() <= 3 for k in reached)}
    assert reached == set(prints) and len(kept) < len(prints)


def test_decontamination_drops_exactly_the_leaks(spark, stages):
    before = stages["simhash_near_dedup"]
    leaky = {r["doc_id"] for r in template_leaks.leaks(before, queries.table(spark, FOLDER, "benchmark")).collect()}
    after = {r["doc_id"] for r in stages["benchmark_decontamination"].collect()}
    assert leaky and after == {r["doc_id"] for r in before.collect()} - leaky


def test_mix_repeats_documents_as_planned(stages):
    rows, names = mixing.with_takes(stages["benchmark_decontamination"], keep=["doc_id"])
    want = {r["doc_id"]: r[names["takes"]] for r in rows.collect() if r[names["takes"]]}
    assert Counter(r["doc_id"] for r in stages["source_mixing"].collect()) == want


def test_records_hold_the_mix(stages):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.vocabulary())
    docs = stages["source_mixing"].orderBy("doc_id").collect()
    start, want = 0, []
    for d in docs:
        ids = [*library.encode(d["text"], add_special_tokens=False).ids, queries.END_ID]
        want.append((d["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in stages["token_records"].orderBy("start").collect()] == want


def test_odd_documents_pass_all_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(300)
    text = docs.first()["text"]
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", None, 0), (2, text, None, None, None), (2, text, None, None, None), (None, text * 40, "en", "s", 1)], docs.schema)
    odd = docs.unionByName(odd).withColumn("size", F.lit("clash")).withColumn("fp", F.lit(1))
    for name, stage in P.STAGES:
        odd = P.written(stage(spark, odd, FOLDER), "odd")
        empty = stage(spark, docs.limit(0), FOLDER)
        assert empty.count() == 0, name
    assert odd.count() > 100

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from staylens.llm import queries
from staylens.llm import record_files as R

SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary())


def plain(library, rows):
    out, start = {}, 0
    for key, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        out[key] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


def test_word_by_word_equals_whole_texts(library):
    encode = R.Encoder(queries.vocabulary())
    rng = random.Random(2)
    bits = ["Don't", "I'LL", "x", "Ünï", "é", "́a", "<|endoftext|>", "a<|startoftext|>b", "ΣΑΣ", "İstanbul", "3.14,", "Straße.", "..,", "abc.,.",
            "日本語", "a​b", "a\xa0b", "a\x1cb", "a\x85b", "﻿q", "tab\tnl\n", "ẞ.", "ﬁn,", "🙂.", "it's,", "a.b", "'s", ".", "don't.", "q r", "\x00z", "k᠎v"]
    for _ in range(1500):
        text = rng.choice(["", " "]) + rng.choice([" ", "  ", "\n", "\r\n", "\t", "\x0b", "\x0c"]).join(rng.choice(bits) for _ in range(rng.randint(1, 9)))
        assert np.frombuffer(encode(text), encode.dtype).tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert encode("") == b"" and encode("   ") == b""


def test_letters_that_grow_when_lowered(library):
    encode = R.Encoder(queries.vocabulary())
    assert encode.wordwise
    for text in ("LİSTESİ.", "TEKLİFİ,", "İ", "İ.", "İ,.", "aİ.b", "ẞİ,", "İstanbul. ve İZMİR,", "Iİ.,"):
        assert np.frombuffer(encode(text), encode.dtype).tolist() == library.encode(text, add_special_tokens=False).ids, text
    rng = random.Random(8)
    letters = [chr(c) for c in range(0xC0, 0x250)] + ["İ", "ı", "ẞ", "ﬁ", "ǅ", "ΐ", "ΰ", "Σ", "ς", "a", "B"]
    for _ in range(4000):
        text = " ".join("".join(rng.choices(letters, k=rng.randint(1, 5))) + rng.choice(["", ".", ",", ".,"]) for _ in range(4))
        assert np.frombuffer(encode(text), encode.dtype).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_segments_of_a_word(library):
    encode, rng = R.Encoder(queries.vocabulary()), random.Random(9)
    signs = [chr(c) for c in range(0x21, 0x7F)] + [chr(c) for c in range(0xA0, 0x100)] + ["ĳ", "́", "<|", "|>", "'s", "'ll", "٣", "²", "日"]
    for _ in range(20_000):
        text = "".join(rng.choices(signs, k=rng.randint(1, 7)))
        assert np.frombuffer(encode(text), encode.dtype).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_other_vocabularies_go_through_the_library(tmp_path):
    import json

    from tokenizers import Tokenizer

    settings = json.load(open(queries.vocabulary()))
    settings["normalizer"] = {"type": "NFC"}  # keeps capitals
    path = tmp_path / "other.json"
    path.write_text(json.dumps(settings))
    encode, library = R.Encoder(str(path)), Tokenizer.from_file(str(path))
    assert not encode.wordwise
    for text in ("Some Words.", "LİSTESİ, ABC", ""):
        assert np.frombuffer(encode(text), encode.dtype).tolist() == library.encode(text, add_special_tokens=False).ids


def test_query_equals_the_library(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in queries.op9_token_records(spark, "/root/testdata/sf0.001").collect()}
    assert got == plain(library, [(d["doc_id"], d["text"]) for d in docs])


def test_round_trip_and_index(spark, library):
    rows = [(5, "hello world"), (None, "no id"), (1, None), (9, ""), (3, "long " * 50_000), (3, "a tie"), (3, "a tie")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("known", F.lit("x")).withColumn("id", F.lit(0)).withColumn("tie", F.lit(1)).repartition(3)
    manifest = R.write_records(df, queries.vocabulary(), 1)
    read = R.read_records(manifest).orderBy("start").collect()
    assert [r["doc_id"] for r in read] == [None, 1, 3, 3, 3, 5, 9]
    assert read[1]["n_tokens"] == 1 and read[-1]["n_tokens"] == 1
    entries = R.index_entries(manifest)
    shuffled = R.fetch_records(entries.orderBy(F.rand(4)), "key")
    found = {(r["key"], r["start"]): r["ids"] for r in shuffled.collect()}
    assert len(found) == 7
    for r in read:
        ids = found[r["doc_id"], r["start"]]
        assert len(ids) == r["n_tokens"] and ids[-1] == 1 and zlib.crc32(np.array(ids, "<u4").tobytes()) == r["ids_crc32"]
    assert sorted(f[-1] for f in found.values()) == [1] * 7


def test_empty_table(spark):
    manifest = R.write_records(spark.createDataFrame([], SCHEMA), queries.vocabulary(), 1)
    assert manifest.count() == 0 and R.read_records(manifest).count() == 0 and R.index_entries(manifest).count() == 0


def test_damage_is_found(spark):
    manifest = R.write_records(spark.createDataFrame([(1, "some words to keep"), (2, "and more")], SCHEMA).coalesce(1), queries.vocabulary(), 1)
    path = manifest.first()["records"].removeprefix("file:")
    data = bytearray(open(path, "rb").read())
    for at in (0, 9, 20, len(data) - 1):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            at = 0
            while at < len(broken):
                _, at = R.unframe(bytes(broken), at)
    assert os.path.getsize(path) == manifest.first()["n_bytes"]


def test_frames_and_masks():
    assert R.unframe(R.frame(b"abc") + R.frame(b""), 0) == (b"abc", 19)
    assert R.unframe(R.frame(b"")) == (b"", 16)
    assert R.masked(b"abc") != zlib.crc32(b"abc")

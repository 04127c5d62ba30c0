from pyspark.sql import functions as F

from staylens.llm import language_id as L
from staylens.llm import queries

SCHEMA = "doc_id bigint, text string, lang string"
EN = "the house of the old king was near the river and the people went there with their horses"
DE = "das haus des alten königs stand nahe am fluss und die leute gingen mit ihren pferden dorthin"


def corpus(spark, extra=()):
    words = {"en": EN.split(), "de": DE.split()}
    rows = []
    for i in range(120):
        lang = ("en", "de")[i % 2]
        w = words[lang]
        rows.append((i, " ".join(w[(i * 7 + j * (1 + i % 3)) % len(w)] for j in range(8 + i % 9)), lang))
    return spark.createDataFrame([*rows, *extra], SCHEMA)


def predict(model, df):
    return {r["doc_id"]: r["found"] for r in df.select("doc_id", L.identify(model, F.col("text")).alias("found")).collect()}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = queries.op1_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000
    out = [r for r in rows if r["held_out"]]
    assert 150 < len(out) < 250
    assert sum(r["lang"] == r["lang_pred"] for r in out) / len(out) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["accepted"] for r in rows)  # clean text in the learned languages stays


def test_held_out_rule(spark):
    import zlib

    rows = spark.range(200).select("id", L.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)


def test_several_centroids_and_rejection(spark):
    model = L.fit(corpus(spark))
    assert model.languages == ["de", "en"]
    assert 2 < len(model.owner) <= 2 * L.CENTROIDS
    odd = spark.createDataFrame(
        [(1, EN, None), (2, DE, None), (3, None, None), (4, "", None), (5, "12 34 -- !!", None), (6, "ξενος λογος μακρυς ", None),
         (7, "zzqx vvkj qqpf xxjw kkvz", None), (8, (EN + " ") * 20000, None)], SCHEMA,
    )
    got = predict(model, odd)
    assert (got[1]["lang_pred"], got[2]["lang_pred"], got[8]["lang_pred"]) == ("en", "de", "en")
    assert got[1]["accepted"] and got[2]["accepted"]
    for i in (3, 4, 5):
        assert tuple(got[i]) == ("und", 0.0, False)
    for i in (6, 7):
        assert got[i]["lang_pred"] in ("en", "de") and not got[i]["accepted"]


def test_nulls_repeats_and_clashing_columns(spark):
    extra = [(500, None, "en"), (501, EN, None), (502, "123", "de")] + [(600 + i, EN, "en") for i in range(60)] + [(None, DE, "de")]
    docs = corpus(spark, extra).withColumn("score", F.lit("x")).withColumn("draw", F.lit(1)).withColumn("share", F.lit(2))
    model = L.fit(docs)
    assert model.languages == ["de", "en"]
    assert predict(model, docs)[502]["lang_pred"] == "und"


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], SCHEMA)
    model = L.fit(empty)
    assert model.languages == []
    assert predict(model, spark.createDataFrame([(1, EN, None)], SCHEMA))[1]["lang_pred"] == "und"
    assert predict(model, empty) == {}


def test_fit_is_repeatable(spark):
    a, b = L.fit(corpus(spark)), L.fit(corpus(spark).repartition(5))
    assert a.languages == b.languages and (abs(a.idf - b.idf) < 1e-6).all() and abs(a.centroids - b.centroids).max() < 1e-4


def test_language_left_out_is_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").cache()
    for lang in ("de", "en", "es", "fr"):
        model = L.fit(docs.filter(F.col("lang") != lang))
        rows = docs.select("lang", F.col("text"), L.identify(model, F.col("text")).alias("found")).collect()
        unseen = [r["found"]["accepted"] for r in rows if r["lang"] == lang]
        assert sum(unseen) / len(unseen) < 0.1, (lang, sum(unseen), len(unseen))
        assert all(r["found"]["accepted"] for r in rows if r["lang"] != lang)


def test_few_texts_in_two_languages_give_no_centroid(spark):
    extra = [(900 + i, f"{EN} {DE} {i}", "de") for i in range(1)]
    only = corpus(spark, extra).filter("lang = 'de'")
    assert not predict(L.fit(only), spark.createDataFrame([(1, EN, None)], SCHEMA))[1]["accepted"]

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from staylens.llm import phrase_mining as P

SCHEMA = "text string, lang string"


def plain(data, least=10, longest=3, top=2000, covered=50):
    """Count, cut, cover and rank without any of the operator's structure."""
    counts, sizes = defaultdict(Counter), Counter()
    for text, lang in data:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, own in counts.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        covers = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    covers[p[i : i + k]] = max(covers[p[i : i + k]], a)
        rows = []
        for p, a in candidates.items():
            if p in covers and 100 * covers[p] >= covered * a:
                continue
            score, _, l, r = min((10**6 * a * a // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            rows.append((" ".join(p), a, l, r, sizes[lang], score))
        rows.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        out += [(lang, i + 1, *row) for i, row in enumerate(rows[:top])]
    return sorted(out)


def found(spark, data, **options):
    return sorted(tuple(r) for r in P.collocations(spark.createDataFrame(data, SCHEMA).repartition(3), **options).collect())


def corpus(n=400, seed=2):
    rng = random.Random(seed)
    words = ["The", "of", "and", "new", "york", "city", "São", "Ünit", "é", "x y", "U.S", "don't"] + [f"w{i}" for i in range(60)]
    marks = [" "] * 12 + [", ", ". ", "\n", "\r\n", "\t", "!", " new york city ", " New York "]

    def text():
        return "".join(words[min(71, int(rng.expovariate(0.06)))] + rng.choice(marks) for _ in range(rng.randint(0, 60)))

    return [(text(), rng.choice(["en", "en", "en", "de", None, "und"])) for _ in range(n)]


@pytest.mark.parametrize("seed", [2, 3])
def test_equals_the_plain_count(spark, seed):
    data = corpus(seed=seed)
    want = plain(data)
    assert len(want) > 50 and found(spark, data) == want


def test_longer_phrases_and_other_parameters(spark):
    data = corpus(200) + [("one two three four five six", "en")] * 12
    for longest in (2, 4, 5):
        assert found(spark, data, min_count=4, max_words=longest, top=30, covered=70) == plain(data, 4, longest, 30, 70)


def test_runs_that_are_cut_and_buffers_that_are_sent(spark, monkeypatch):
    """A text longer than many runs, full of one phrase: every window counts once."""
    monkeypatch.setattr(P, "RUN", 7)
    monkeypatch.setattr(P, "BUFFER", 50)
    monkeypatch.setattr(P, "WORD_BUFFER", 5)
    rng = random.Random(4)
    data = [(" ".join(rng.choice("abcd") for _ in range(3000)), "en"), ("z " * 500, "en"), (" ".join("pq" * 30), None)]
    for longest in (2, 3, 4):
        assert found(spark, data, max_words=longest) == plain(data, longest=longest)


def test_a_full_filter_changes_no_result(spark, monkeypatch):
    monkeypatch.setattr(P, "FILTER_BITS", 1 << 16)
    data = corpus(150)
    want = found(spark, data)
    monkeypatch.setattr(P, "_holds", lambda table, columns: P.np.ones(len(columns[0]), bool))
    assert want == plain(data) == found(spark, data)


def test_words_that_share_a_key_get_another_seed(spark, monkeypatch):
    words = spark.createDataFrame([("en", f"w{i}", 1) for i in range(50)], "lang string, word string, n bigint")
    real = P._key
    monkeypatch.setattr(P, "_key", lambda seed: real(seed) % 7 if seed < 2 else real(seed))
    assert P.exact_seed(words) == 2


def test_task_and_sql_hash_agree(spark):
    df = spark.createDataFrame([("en", "Straße"), ("", ""), ("日本", "a" * 500), ("de", "é" * 9)], "lang string, word string")
    for seed in (0, 7):
        keys = P._python_key(seed)
        for r in df.select("lang", "word", P._key(seed).alias("key")).collect():
            assert keys(r["lang"], [r["word"].encode()]) == [r["key"]]


def test_products_beyond_64_bits(spark):
    big = 10**12
    one = spark.createDataFrame([(1, big), (2, big + 7)], "w1 bigint, n bigint")
    two = spark.createDataFrame([(1, 2, big - 3)], "w1 bigint, w2 bigint, n bigint")
    row = P.scored({1: one, 2: two}, 2).first()
    assert row["score"] == 10**6 * (big - 3) ** 2 // (big * (big + 7)) and (row["l"], row["r"]) == (big, big + 7)


def test_nulls_empty_long_texts_ties_and_clashing_columns(spark):
    data = [(None, "en"), ("", None), ("!!!", "en"), ("solo", "en"), ("a b " * 40_000, None)] + [("c d, e f", "de")] * 10
    df = spark.createDataFrame(data, SCHEMA).withColumns({"word": F.lit(1), "n": F.lit("x"), "key": F.lit(None), "rank": F.lit(2)})
    assert sorted(tuple(r) for r in P.collocations(df).collect()) == plain(data)
    assert [r[2] for r in found(spark, data) if r[0] == "de"] == ["c d", "e f"]
    assert found(spark, [("nothing is frequent here", "en")]) == []
    assert P.collocations(spark.createDataFrame([], SCHEMA)).collect() == []

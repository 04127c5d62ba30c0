import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from staylens.llm import queries
from staylens.llm import template_leaks as T

DOC = "doc_id bigint, text string"
ITEM = "item_id bigint, text string"
QUESTION = "In the morning Alice bought 12 apples for 3 dollars each and then Bob sold Alice 12 pears so how much did Alice pay"


def plain_words(text):
    import regex

    free = re.sub(f"[{T.NAME}-{T.UNIT_SLOT}]", "", text or "")
    space = r" \t\n\x0b\f\r"
    marked = regex.sub(rf"(?<=[^{space}.!?:;][{space}]{{1,3}})(?=\p{{Lu}}\p{{Ll}})", T.NAME, free).lower()
    joined = re.sub(r"(?<=[0-9])[.,:/](?=[0-9])", "", marked)
    return [w for w in re.sub(T.PARTING, " ", joined).split(" ") if w]


def plain_windows(text):
    words, out = plain_words(text), {}
    slots = []
    for i, w in enumerate(words):
        number = "0" <= w[0] < ":"
        unit = w in T.UNITS and i > 0 and "0" <= words[i - 1][0] < ":"
        slots.append("<name>" if w[0] == T.NAME else "<number>" if number else "<unit>" if unit else None)
    for i in range(len(words) - T.WINDOW + 1):
        own = [(j, words[i + j]) for j in range(T.WINDOW) if slots[i + j]]
        out[i] = (tuple(s or w for s, w in zip(slots[i : i + T.WINDOW], words[i : i + T.WINDOW])), own)
    return out


def plain_leaks(docs, items):
    found = {}
    index, total = defaultdict(list), {}
    for item, text in items:
        good = {p: w for p, w in plain_windows(text).items() if len(w[1]) <= T.WINDOW // 2}
        total[item] = len(good)
        for p, (key, slots) in good.items():
            index[key].append((item, p, slots))
    for doc, text in docs:
        runs = defaultdict(lambda: (set(), set()))
        for p, (key, slots) in plain_windows(text).items():
            for item, q, other in index.get(key, ()):
                places, pairs = runs[item, p - q]
                places.add(q)
                pairs.update((a[1], b[1]) for a, b in zip(other, slots))
        windows, changed = defaultdict(set), defaultdict(int)
        for (item, _), (places, pairs) in runs.items():
            if len({a for a, _ in pairs}) == len(pairs):
                windows[item] |= places
                changed[item] = max(changed[item], sum(a != b for a, b in pairs))
        for item, places in windows.items():
            if len(places) >= min(T.NEEDED, total[item]):
                found[doc, item] = (len(places), total[item], changed[item])
    return found


def leaks(spark, docs, items):
    rows = T.leaks(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM)).collect()
    return {(r["doc_id"], r["item_id"]): r for r in rows}


def test_query_equals_plain_version(spark):
    folder = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    want = plain_leaks(docs, items)
    got = {(r["doc_id"], r["item_id"]): (r["windows"], r["item_windows"], r["changed"]) for r in queries.op7_template_leaks(spark, folder).collect()}
    assert got == want
    flat = [(i, " ".join(t.split())) for i, t in docs]
    inside = {(d, i) for i, text in items for d, t in flat if " ".join(text.split()) in t}
    assert len(inside) > 5 and inside <= set(got)


def test_reparameterised_question(spark):
    other = "Pre text here. " + QUESTION.replace("Alice", "Zoë").replace("12", "40").replace("Bob", "Max").replace("dollars", "euros") + " and so on"
    mixed_up = "In the morning Alice bought 12 apples for 3 dollars each and then Bob sold Carol 99 pears so how much did Dora pay"
    words = "the quick brown fox jumps over a lazy dog and runs far away from here to there again".split()
    docs = [(1, other), (2, mixed_up), (3, " ".join(words * 5)), (4, QUESTION.upper()), (5, f"x {QUESTION} y"), (6, QUESTION.replace(" ", "\n\t "))]
    got = leaks(spark, docs, [(7, QUESTION)])
    assert got[1, 7]["kind"] == "reparameterised" and got[1, 7]["changed"] >= 4
    assert got[5, 7]["kind"] == "verbatim" and got[5, 7]["changed"] == 0
    assert (2, 7) not in got and (3, 7) not in got


def test_long_texts_across_pieces(spark):
    rng = random.Random(3)
    filler = lambda n: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))
    docs = [(n, f"{filler(n)} {QUESTION} {filler(30)}") for n in range(T.PIECE - 40, T.PIECE + 4)] + [(1000, filler(60_000) + " " + QUESTION)]
    got = leaks(spark, docs, [(7, QUESTION)])
    assert {d for d, _ in got} == {d for d, _ in docs}
    assert {(k, (r["windows"], r["item_windows"], r["changed"])) for k, r in got.items()} == set(plain_leaks(docs, [(7, QUESTION)]).items())


def test_random_texts_equal_plain_version(spark):
    rng = random.Random(9)
    bits = ["Anna", "Tom", "5", "12", "km", "cm", "the", "ran", "far.", "so", "He", "3.5", "kg", "x1", "a", "-", "(b)", "c:"]
    items = [(i, " ".join(rng.choices(bits, k=rng.randint(5, 40)))) for i in range(12)]
    docs = []
    for i in range(60):
        text = rng.choice(items)[1]
        for _ in range(rng.randint(0, 4)):
            text = text.replace(rng.choice(bits), rng.choice(bits), rng.randint(1, 3))
        docs.append((i, " ".join(rng.choices(bits, k=rng.randint(0, 90))) + " " + text + " " + " ".join(rng.choices(bits, k=rng.randint(0, 90)))))
    got = {k: (r["windows"], r["item_windows"], r["changed"]) for k, r in leaks(spark, docs, items).items()}
    assert got == plain_leaks(docs, items) and got


def test_short_items_nulls_repeats_and_empty_tables(spark):
    docs = [(1, None), (2, ""), (None, f"{QUESTION} tail"), (4, QUESTION), (4, QUESTION), (5, "one two three four five six seven eight"), (6, "clean text without it")]
    items = [(1, None), (2, "one two three"), (3, QUESTION), (3, QUESTION), (4, "one two three four five six seven eight"), (None, "")]
    rows = T.leaks(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM)).collect()
    assert sorted((str(r["doc_id"]), r["item_id"]) for r in rows) == [("4", 3), ("5", 4), ("None", 3)]
    df = spark.createDataFrame(docs, DOC).withColumn("pos", F.lit("x")).withColumn("hash", F.lit(1)).withColumn("item", F.lit(1))
    bench = spark.createDataFrame(items, ITEM).withColumn("windows", F.lit("x"))
    out = T.decontaminated(df, bench)
    assert out.columns == df.columns and sorted(r["doc_id"] for r in out.collect()) == [1, 2, 6]
    assert T.decontaminated(df.limit(0), bench).count() == 0 and T.decontaminated(df, bench.limit(0)).count() == len(docs)


def test_no_python_on_the_way(spark):
    plan = queries.op7_template_leaks(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_one_edited_value_does_not_hide_the_rest_of_a_run(spark):
    words = "they walked along the quiet river until evening came and nobody spoke about what had happened before".split()
    passage = " ".join(["then 12 boats", *words, "and 12 more came"])
    three = " ".join(["then 12 boats", *words[:6], "with 12 men", *words[6:], "and 12 more came"])
    docs = [(1, passage.replace("12 more", "15 more")), (2, passage.replace("12", "15")), (3, three.replace("12 more", "15 more")), (4, QUESTION)]
    got = leaks(spark, docs, [(7, passage), (8, three)])
    assert got[1, 7]["windows"] == len(words) - T.WINDOW + 3 and got[1, 7]["changed"] == 0
    assert got[2, 7]["windows"] == got[2, 7]["item_windows"] and got[2, 7]["changed"] == 1
    assert got[3, 8]["windows"] == got[3, 8]["item_windows"] - 3 and got[3, 8]["changed"] == 0
    assert not any(d == 4 for d, _ in got)


def test_short_item_inside_running_text(spark):
    item = "What is the tallest mountain range on earth"
    unit = "Hours later the old boat came back empty"
    docs = [(1, f"answer this {item} please"), (2, f"Heading\n{item}\nmore"), (3, f"First. {item}"), (4, f"it took 5 {unit.lower()} again"), (5, f"look, {item} now")]
    got = leaks(spark, docs, [(7, item), (8, unit)])
    assert set(got) == {(1, 7), (2, 7), (3, 7), (4, 8), (5, 7)}
    assert all((r["windows"], r["item_windows"], r["kind"]) == (1, 1, "verbatim") for r in got.values())


def found(spark, docs, items):
    rows = T.all_leaks(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM)).collect()
    assert len(rows) == len({(r["doc_id"], r["item_id"], r["text_hash"]) for r in rows})
    return {(r["doc_id"], r["item_id"]): r for r in rows}


def test_items_without_a_template_window_are_found_whole(spark):
    seven = "where does the Rhine river begin exactly"
    numbers = " ".join(str(n) for n in range(3, 19))
    long_numbers = " ".join(str(n * 7) for n in range(90))
    items = [(1, seven), (2, numbers), (3, "Paris"), (4, long_numbers), (5, "what is love")]
    filler = "plain words without any meaning at all " * 12
    docs = [
        (1, f"tell me {seven}? thanks"), (2, f"x {numbers} y"), (3, "paris."), (4, "we went to Paris in spring"), (5, seven.replace("Rhine", "Elbe")),
        (6, numbers.replace("9", "77")), (7, f"{filler}{seven.upper()} {filler}"), (8, f"{filler}{long_numbers}"), (9, "What is love?"), (10, "so what is love now"),
        (11, " ".join(numbers.split()[:-1])), (12, None), (13, ""),
    ]
    got = found(spark, docs, items)
    assert set(got) == {(1, 1), (7, 1), (2, 2), (3, 3), (8, 4), (9, 5)}
    assert {r["kind"] for r in got.values()} == {"verbatim"} and got[8, 4]["windows"] == 90 - T.WINDOW + 1
    kept = T.decontaminated(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM))
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 5, 6, 10, 11, 12, 13]


def test_whole_items_at_every_place_of_a_piece(spark):
    item = "one two three four five"
    docs = [(n, "x " * n + item + " y" * 20) for n in range(T.PIECE - 8, T.PIECE + 3)]
    assert set(found(spark, docs, [(1, item)])) == {(d, 1) for d, _ in docs}


def test_null_and_repeated_item_ids(spark):
    other = "a second text of eighteen words or so that stands in the benchmark under the very same identifier here"
    docs = [(1, f"x {QUESTION} y"), (2, f"x {other} y"), (None, "where is it now then"), (4, f"{other} {QUESTION}")]
    got = found(spark, docs, [(None, QUESTION), (8, QUESTION), (9, other), (9, QUESTION), (None, "where is it now then")])
    assert set(got) == {(1, None), (1, 8), (1, 9), (2, 9), (4, None), (4, 8), (4, 9), (None, None)}
    assert got[2, 9]["item_windows"] == len(other.split()) - T.WINDOW + 1


def test_a_window_shared_by_many_items_and_documents_makes_no_pairs(spark):
    """A stem of nine words in 300 items and 300 documents, ten of which go on as an item does."""
    stem = "please read the following story and answer this now"
    rng = random.Random(4)
    ends = [" ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(14)) for _ in range(300)]
    items = [(i, f"{stem} {e}") for i, e in enumerate(ends)]
    docs = [(i, f"{stem} {e if i < 10 else ' '.join(reversed(e.split()))}") for i, e in enumerate(ends)]
    docs_df, items_df = spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM)
    rows = docs_df.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash"), "text")
    windows = T.benchmark_windows(T._items(items_df, "item_id", "text"))
    assert windows.filter("NOT anchor AND NOT inside").count() == 2 * 300
    met = T._matches(rows, windows)
    assert met.count() <= 10 * (len(items[0][1].split()) + 3)
    got = found(spark, docs, items)
    assert set(got) == {(i, i) for i in range(10)}
    assert {r["windows"] for r in got.values()} == {16} and {r["item_windows"] for r in got.values()} == {16}


def test_a_family_of_one_template_is_judged_by_one_item(spark):
    def question(n):
        return f"the farmer counted {n} sheep and sold half of them to {n + 1000} people in town before noon today"

    docs = [(1, f"x {question(7)} y"), (2, "nothing of the kind in here at all and nothing else either")]
    got = found(spark, docs, [(i, question(i)) for i in range(100, 100 + T.COMMON + 9)])
    assert set(got) == {(1, 100)} and got[1, 100]["kind"] == "reparameterised"
    few = found(spark, docs, [(i, question(i)) for i in range(100, 104)])
    assert set(few) == {(1, i) for i in range(100, 104)}


def each(spark, docs, items):
    rows = T.all_leaks(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM), every_item=True).collect()
    assert len(rows) == len({(r["doc_id"], r["item_id"], r["text_hash"]) for r in rows})
    return {(r["doc_id"], r["item_id"]): (r["windows"], r["item_windows"], r["changed"]) for r in rows}


def test_a_stem_of_many_items_is_a_leak_of_all_of_them(spark):
    """Fourteen words are seven windows, enough for a leak, and none of them is rare; a second text has six of them at two places."""
    stem = "please read the following story with care and then answer this one question now"
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=7))
    items = [(i, f"{stem} " + " ".join(word() for _ in range(12))) for i in range(T.COMMON + 9)]
    parted = " ".join([*stem.split()[:10], word(), word(), *stem.split()[4:]])
    docs = [(1, f"x {stem}"), (2, " ".join(stem.split()[:12])), (3, items[5][1]), (4, f"{parted} {' '.join(items[7][1].split()[14:])}")]
    got = each(spark, docs, items)
    assert got == plain_leaks(docs, items)
    assert {i for d, i in got if d == 1} == {i for i, _ in items} and not any(d == 2 for d, _ in got)


def test_every_item_of_a_large_class_and_items_that_only_look_like_it(spark):
    def question(a, b):
        return f"the farmer counted {a} sheep and sold half of them to {b} people in town before noon today"

    items = [(0, question(5, 5))] + [(i, question(i, i + 1000)) for i in range(100, 100 + T.COMMON + 9)]
    docs = [(1, f"x {question(7, 8)} y"), (2, f"x {question(110, 1110)} y"), (3, f"x {question(6, 6)} y"), (4, f"x {question(110, 8)}")]
    got = each(spark, docs, items)
    assert got == plain_leaks(docs, items)
    assert got[2, 110][2] == 0 and got[4, 110][2] == 1 and (1, 0) not in got and (3, 0) in got
    first = found(spark, docs, items)
    assert (1, 100) in first and len(first) < len(got)
    members = T.item_classes(spark.createDataFrame(items, ITEM)).collect()
    assert sorted(r["item_id"] for r in members) == [i for i, _ in items[1:]] and {r["first"]["item"] for r in members} == {100}


def test_random_texts_of_large_classes_equal_plain_version(spark, monkeypatch):
    monkeypatch.setattr(T, "COMMON", 2)
    rng = random.Random(12)
    parts = ["the old man ran far so fast that day", "she had a plan and then went home alone again", "then Anna gave 12 km to Tom and 12 more", "we saw 5 kg of x1 for Tom or Bob there"]
    def text():
        out = " ".join(rng.choices(parts, k=rng.randint(1, 4)))
        for _ in range(rng.randint(0, 3)):
            out = out.replace(rng.choice(["Anna", "Tom", "Bob", "12", "5"]), rng.choice(["Anna", "Tom", "Zoe", "77", "8"][:3] if rng.random() < 0.5 else ["77", "8"]), 9)
        return out
    items = [(i, text()) for i in range(40)]
    docs = [(i, "so it went on. " * rng.randint(0, 3) + text() + " and " + text()) for i in range(40)]
    exact = T.COMMON
    got = each(spark, docs, items)
    monkeypatch.setattr(T, "COMMON", 10**6)
    assert exact == 2 and got == each(spark, docs, items) and len(got) > 40

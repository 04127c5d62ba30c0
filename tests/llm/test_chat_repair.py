import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from staylens.llm import chat_repair as C
from staylens.llm import queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
LEGAL = re.compile(r"^(?:s(?:ua)+|(?:ua)+)$")


def plain_cost(roles):
    """Least cost over all choices of roles, merges and short insertions, by trying them."""
    codes = [C.role_code(r) for r in roles]
    fills = [(), (0,), (1,), (2,), (0, 1), (1, 2), (2, 1), (0, 1, 2)]
    best = float("inf")

    def legal(seq):
        return LEGAL.match("".join("sua"[r] for r in seq))

    def go(i, seq, cost):
        nonlocal best
        if cost >= best:
            return
        if i == len(codes):
            for tail in ((), (2,), (1, 2)):
                if legal([*seq, *tail]):
                    best = min(best, cost + C.COST["insert"] * len(tail))
            return
        for role in range(3):
            change = 0 if role == codes[i] else C.COST["relabel"]
            if seq and seq[-1] == role:
                go(i + 1, seq, cost + change + C.COST["merge"])
            for fill in fills:
                new = [*seq, *fill, role]
                if all(b in C.NEXT[a] for a, b in zip([C.START, *new], new)):
                    go(i + 1, new, cost + change + C.COST["insert"] * len(fill))

    go(0, [], 0.0)
    return best


def chats(df):
    return {r["conv"]: (r["chat"], r["cost"]) for r in C.rendered(df).collect()}


def roles_in(chat):
    return "".join(r[0] for r in re.findall(r"<\|(system|user|assistant)\|>", chat))


def test_least_cost_of_all_short_chats(spark):
    names = ["system", "user", "assistant", None]
    seqs = [s for n in range(1, 5) for s in itertools.product(names, repeat=n)]
    rows = [(c, t, role, f"t{t}") for c, seq in enumerate(seqs) for t, role in enumerate(seq)]
    out = chats(C.repaired(spark.createDataFrame(rows, SCHEMA)))
    assert len(out) == len(seqs)
    for c, seq in enumerate(seqs):
        chat, cost = out[str(c)]
        assert LEGAL.match(roles_in(chat)), (seq, chat)
        assert cost == plain_cost(seq), (seq, chat, cost)
        assert re.findall(r"t\d", chat) == [f"t{t}" for t in range(len(seq))]  # no text is lost or moved


@pytest.fixture()
def many_tasks(spark):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_one_chat_over_many_tasks(spark, many_tasks):
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["system", "user", "assistant", "User ", "bot", None]), f"x{t}") for t in range(3000)]
    rows += [(2 + i, t, rng.choice(["user", "assistant"]), f"y{t}") for i in range(200) for t in range(rng.randint(1, 6))]
    out = chats(C.repaired(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    codes = [C.role_code(r[2]) for r in rows[:3000]]
    costs, _ = C.forward(codes, C.start_costs())
    end = C.end_state(costs)
    chat, cost = out["1"]
    assert cost == costs[end] + C.COST["insert"] * len(C.END_INSERTS[end])
    assert LEGAL.match(roles_in(chat)) and re.findall(r"x\d+", chat) == [f"x{t}" for t in range(3000)]
    assert chat.count("<|end|>") == len(roles_in(chat))
    assert len(out) == 201


def test_rendering(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b <|end|>"), (1, 2, "assistant", None), (1, 3, "user", "c")]
    chat, cost = chats(C.repaired(spark.createDataFrame(rows, SCHEMA)))["1"]
    assert chat == "<|user|>\na\nb < |end|><|end|>\n<|assistant|>\n<|end|>\n<|user|>\nc<|end|>\n<|assistant|>\n<|end|>\n" and cost == 4.0


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [(None, 1, "user", "a"), (None, 2, "assistant", "b"), (3, None, "user", "q"), (3, 1, "assistant", "r"), (4, 1, "user", "z"), (4, 1, "user", "z"),
            (5, 1, None, None), (6, 1, "system", "l" * 2_000_000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("at", F.lit("x")).withColumn("task", F.lit(1)).withColumn("conv", F.lit(1))
    out = chats(C.repaired(df))
    assert set(out) == {None, "3", "4", "5", "6"}
    assert out[None][1] == 0 and out["3"][1] == 0 and out["4"][1] == 2.0  # the second becomes the answer
    assert len(out["6"][0]) > 2_000_000
    assert C.repaired(df.limit(0)).count() == 0


def test_query_keeps_every_turn(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.op4_chat_repair(spark, folder).collect()
    turns = spark.read.parquet(f"{folder}/conversations.parquet").collect()
    assert sorted((r["conv_id"], r["turn"], r["role"]) for r in rows) == sorted((t["conv_id"], t["turn"], t["role"]) for t in turns)


def test_repairs_do_not_depend_on_the_partitioning(spark, many_tasks):
    """Many repairs cost the same; which one is taken may not change with the number of tasks."""
    rng = random.Random(8)
    rows = [(1, t // 2, rng.choice(["system", "user", "assistant", "bot", None]), f"x{t}") for t in range(1200)]
    rows += [(None, 5, rng.choice(["user", "assistant"]), "same") for t in range(600)] + [(2, t, "user", "u") for t in range(700)]
    rows += [(3 + i, t, rng.choice(["user", "assistant", "system"]), f"y{t}") for i in range(60) for t in range(rng.randint(1, 6))]
    df = spark.createDataFrame(rows, SCHEMA)
    old, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for parts, split in (("1", 1), ("7", 3), ("50", 11)):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            found.append(chats(C.repaired(df.repartition(split))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert found[0] == found[1] == found[2] and len(found[0]) == 63


def test_turns_that_nothing_tells_apart_lie_in_several_tasks(spark, many_tasks):
    rows = [(None, 1, "user", "the same turn")] * 2000 + [(i, 1, "user", "x") for i in range(1000)]
    out = C.repaired(spark.createDataFrame(rows, SCHEMA))
    tasks = [r["count"] for r in out.filter("conv IS NULL").groupBy(F.shiftright("at", C.TASK_BITS)).count().collect()]
    assert len(tasks) >= 4 and max(tasks) <= 1000 and out.count() == 3000

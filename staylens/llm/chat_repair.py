"""Repair role sequences of chats at least cost, then render them.

A legal chat is an optional system turn, then user and assistant in turn, ending with the
assistant. Dynamic programming over the automaton of the last role chooses for each turn to
keep it, relabel it, merge it with the turn before, or put empty turns before it; the sum of
``COST`` is the least possible. The rendered chat is the concatenation of its turns' pieces.

Turns are put in order of conversation and turn over all tasks, so one conversation may span
many. Most lie within one task and are solved there. For the few at task borders (the first
and last of a task) each task's stretch becomes a small table of least costs from each state to
each. Chaining the tables gives every stretch the costs that a walk over the whole chat would have at
its start. From these each stretch tells which state its best way to each end state starts in;
chaining that from the chat's end backwards gives its end state, and then every stretch is solved.

Defined results: null text is empty; role names are compared in lower case without outer space;
null and unknown roles must be relabelled; null conversation ids are one conversation; turns
with equal numbers are ordered by role and the SHA-256 of their text, null numbers come first; the marks of the
format are broken up inside texts; an empty table gives no rows. Of repairs with equal cost the
one is taken that, from the chat's end backwards, has the earlier state in ``ROLES`` (the start last);
so it does not depend on how turns lie in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import written

ROLES = ("system", "user", "assistant")
START = len(ROLES)
STATES = len(ROLES) + 1
#: Cost of one change.
COST = {"relabel": 2.0, "merge": 1.0, "insert": 3.0}
#: Legal next roles of each state, and the state that may end a chat.
NEXT = {START: (0, 1), 0: (1,), 1: (2,), 2: (1,)}
LAST = 2
TASK_BITS = 33


def _bridges() -> dict[tuple[int, int], list[int]]:
    """Fewest empty turns that make a role legal after a state; missing where there is no way."""
    found = {}
    for start in range(STATES):
        wave, seen = [(start, [])], set()
        while wave:
            rest = []
            for state, path in wave:
                for role in NEXT[state]:
                    if role not in seen:
                        seen.add(role)
                        found[start, role] = path
                        rest.append((role, [*path, role]))
            wave = rest
    return found


BRIDGES = _bridges()
END_INSERTS = {s: [] if s in (LAST, START) else [*BRIDGES[s, LAST], LAST] for s in range(STATES)}


def _steps() -> dict[int | None, list[tuple[int, int, float, bool]]]:
    """For a role as written (None if unknown): ``(state, role, cost, merged)`` of all moves."""
    table = {}
    for written_role in (*range(len(ROLES)), None):
        moves = []
        for state in range(STATES):
            for role in range(len(ROLES)):
                change = 0.0 if role == written_role else COST["relabel"]
                if state == role:
                    moves.append((state, role, change + COST["merge"], True))
                if (state, role) in BRIDGES and not (state == role and change + COST["merge"] <= change + COST["insert"] * len(BRIDGES[state, role])):
                    moves.append((state, role, change + COST["insert"] * len(BRIDGES[state, role]), False))
        # A state and role have one cheapest move.
        best = {}
        for m in moves:
            if (m[0], m[1]) not in best or m[2] < best[m[0], m[1]][2]:
                best[m[0], m[1]] = m
        table[written_role] = list(best.values())
    return table


STEPS = _steps()


def role_code(role: str | None) -> int | None:
    role = role.strip().lower() if isinstance(role, str) else None
    return ROLES.index(role) if role in ROLES else None


def forward(codes: list[int | None], costs: np.ndarray) -> tuple[np.ndarray, list[dict[int, tuple[int, float, bool]]]]:
    """Least cost of each end state from start costs, and for each turn the move into each state."""
    trail = []
    for code in codes:
        after, moves = np.full(STATES, np.inf), {}
        for state, role, cost, merged in STEPS[code]:
            if costs[state] + cost < after[role]:
                after[role] = costs[state] + cost
                moves[role] = (state, cost, merged)
        trail.append(moves)
        costs = after
    return costs, trail


def backward(trail: list[dict], end: int) -> list[tuple[int, int, float, bool]]:
    """``(state before, role, cost, merged)`` of each turn on the best way to ``end``."""
    path = []
    for moves in reversed(trail):
        state, cost, merged = moves[end]
        path.append((state, end, cost, merged))
        end = state
    return path[::-1]


def start_costs(state: int = START) -> np.ndarray:
    costs = np.full(STATES, np.inf)
    costs[state] = 0.0
    return costs


def end_state(costs: np.ndarray) -> int:
    return int(np.argmin([c + COST["insert"] * len(END_INSERTS[s]) for s, c in enumerate(costs)]))


def _open(role: int) -> str:
    return f"<|{ROLES[role]}|>\n"


CLOSE = "<|end|>\n"
OUT = "at bigint, conv string, turn bigint, role string, action string, role_out string, inserted int, cost double, piece string"


def _solved(rows: pd.DataFrame, path: list[tuple[int, int, float, bool]], codes: list[int | None], final: bool) -> pd.DataFrame:
    """Output rows of a stretch; ``final`` if the conversation ends with it."""
    out = []
    for i, ((state, role, cost, merged), code) in enumerate(zip(path, codes)):
        text = (rows["text"].iloc[i] or "").replace("<|", "< |")
        inserted = [] if merged else BRIDGES[state, role]
        piece = "\n" if merged else ("" if state == START else CLOSE) + "".join(_open(r) + CLOSE for r in inserted) + _open(role)
        piece += text
        if final and i == len(path) - 1:
            tail = END_INSERTS[role]
            piece += CLOSE + "".join(_open(r) + CLOSE for r in tail)
            inserted, cost = [*inserted, *tail], cost + COST["insert"] * len(tail)
        action = "+".join([*(["relabel"] if role != code else []), *(["merge"] if merged else [])]) or "keep"
        out.append((action, ROLES[role], len(inserted), cost, piece))
    done = pd.DataFrame(out, columns=["action", "role_out", "inserted", "cost", "piece"])
    return pd.concat([rows[["at", "conv", "turn", "role"]].reset_index(drop=True), done], axis=1)


def solve_whole(rows: pd.DataFrame) -> pd.DataFrame:
    codes = [role_code(r) for r in rows["role"]]
    costs, trail = forward(codes, start_costs())
    return _solved(rows, backward(trail, end_state(costs)), codes, True)


def repaired(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """One row a turn, in order of ``at``: ``(at, conv, turn, role, action, role_out, inserted, cost, piece)``.

    ``conv`` is the id as text (null stays null). A conversation's pieces in order are the rendered chat.
    """
    rows = turns.select(
        F.col(conv_col).cast("string").alias("conv"), F.col(turn_col).cast("bigint").alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
    )
    # Rows that nothing else parts have a number, written before rows are ranged by it.
    numbered = written(rows.withColumns({"mark": F.sha2("text", 256), "tie": F.monotonically_increasing_id()}), "chat-rows")
    order = ["conv", "turn", "role", "mark", "tie"]
    ranged = numbered.repartitionByRange(*order).sortWithinPartitions(*order).drop("mark", "tie")
    placed = written(ranged.withColumn("at", F.monotonically_increasing_id()), "chat-turns")
    placed = placed.withColumn("task", F.shiftright("at", TASK_BITS))
    # Conversations that more than one task holds: at most one a border. They have a name here that is never null.
    name = F.coalesce(F.concat(F.lit("="), F.col("conv")), F.lit(""))
    ends = placed.select(name.alias("name"), "task").distinct()
    spread = written(ends.groupBy("name").agg(F.count("*").alias("tasks")).filter(F.col("tasks") > 1).select("name"), "chat-spread")
    named = placed.withColumn("name", name)
    inner = named.join(spread, "name", "left_anti").drop("name")
    border = named.join(spread, "name")

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if not len(held):
                continue
            convs = held["conv"].fillna("\0")  # at most one chat has no id
            new = np.flatnonzero(np.r_[True, convs.to_numpy()[1:] != convs.to_numpy()[:-1]])
            done = [solve_whole(held.iloc[a:b]) for a, b in zip(new[:-1], new[1:])]
            held = held.iloc[new[-1] :]
            if done:
                yield pd.concat(done, ignore_index=True)
        if held is not None and len(held):
            yield solve_whole(held)

    ordered = inner.repartition("conv").sortWithinPartitions("conv", "at").drop("task")
    inside = ordered.mapInPandas(whole, OUT)

    def table(rows: pd.DataFrame) -> pd.DataFrame:
        codes = [role_code(r) for r in rows.sort_values("at")["role"]]
        costs = [forward(codes, start_costs(s))[0].tolist() for s in range(STATES)]
        return pd.DataFrame({"name": [rows["name"].iloc[0]], "task": [rows["task"].iloc[0]], "costs": [sum(costs, [])]})

    def chained(tables: pd.DataFrame) -> pd.DataFrame:
        """Costs at the start of each stretch of one conversation: as many rows as tasks hold it."""
        tables = tables.sort_values("task", ignore_index=True)
        at = [start_costs()]
        for c in tables["costs"]:
            at.append((at[-1][:, None] + np.array(c).reshape(STATES, STATES)).min(axis=0))
        last = [i == len(tables) - 1 for i in range(len(tables))]
        return pd.DataFrame({"name": tables["name"], "task": tables["task"], "costs": [c.tolist() for c in at[:-1]], "final": last})

    def ways(rows: pd.DataFrame) -> pd.DataFrame:
        """For each end state of a stretch the state its best way starts in, and the end state it has as the chat's end."""
        codes = [role_code(r) for r in rows.sort_values("at")["role"]]
        costs, trail = forward(codes, np.array(rows["costs"].iloc[0]))
        starts = [backward(trail, s)[0][0] if np.isfinite(costs[s]) else -1 for s in range(STATES)]
        return pd.DataFrame({"name": [rows["name"].iloc[0]], "task": [rows["task"].iloc[0]], "starts": [starts], "end": [end_state(costs)]})

    def linked(tables: pd.DataFrame) -> pd.DataFrame:
        tables = tables.sort_values("task", ascending=False, ignore_index=True)
        ends = [int(tables["end"].iloc[0])]
        for starts in tables["starts"].iloc[:-1]:
            ends.append(int(starts[ends[-1]]))
        return pd.DataFrame({"name": tables["name"], "task": tables["task"], "last": ends})

    keys = ["name", "task"]
    stretches = border.select(*keys, "at", "role").groupBy(*keys).applyInPandas(table, "name string, task bigint, costs array<double>")
    starts = stretches.groupBy("name").applyInPandas(chained, "name string, task bigint, costs array<double>, final boolean")
    starts = written(starts, "chat-starts")
    tables = border.select(*keys, "at", "role").join(starts.select(*keys, "costs"), keys).groupBy(*keys)
    tables = tables.applyInPandas(ways, "name string, task bigint, starts array<int>, end int")
    bounds = written(tables.groupBy("name").applyInPandas(linked, "name string, task bigint, last int").join(starts, keys), "chat-bounds")

    def between(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at", ignore_index=True)
        codes = [role_code(r) for r in rows["role"]]
        _, trail = forward(codes, np.array(rows["costs"].iloc[0]))
        return _solved(rows, backward(trail, int(rows["last"].iloc[0])), codes, bool(rows["final"].iloc[0]))

    across = border.join(bounds, keys).groupBy(*keys).applyInPandas(between, OUT)
    return inside.unionByName(across)


def rendered(turns: DataFrame) -> DataFrame:
    """Whole chats ``(conv, chat, cost)`` from repaired turns, for tables in which every chat fits in memory."""
    lists = turns.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("pieces"), F.sum("cost").alias("cost"))
    return lists.select("conv", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("chat"), "cost")

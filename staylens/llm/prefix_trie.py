"""The trie of conversation prefixes, with count-min screening of prefix digests.

A prefix is known by its depth and a digest that adds up over its turns, so all prefixes of all
conversations come from one running sum. A count-min sketch counts the digests. Its estimate is never
too low: an estimate of one proves that a prefix belongs to a single conversation, and so do all
longer ones of that conversation. That tail is finished where it lies. Only prefixes that may be
shared, and the first proven one, which hangs on them, are shuffled by digest and grouped exactly.

Sums over a subtree need no walk: each node lends its value to its smallest member, and a node's sum
is that of what its members were lent at its depth or deeper.

A conversation may hold any share of the turns and a prefix any share of the conversations: order
and running sums go over ranges (:mod:`staylens.operators.scan`), groups are summed per task first,
and member lists are hashed as a stream of ordered chunks. The sketch holds at most
``2 * WIDTH`` bits for the driver and the tasks; a fuller one only proves fewer tails.

Digests: SHA-256 of (place, turn) in four 32-bit lanes, each summed. Turn texts are not shuffled.

Defined results: turns without conversation id are left out; null roles and texts are empty; turns of
equal number are ordered by role, then by the SHA-256 of their text; repeated turns count each time; an
empty table gives no nodes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import written
from staylens.operators.scan import running_totals

#: Counters of each of the sketch's two rows at most; they are doubled from LEAST_WIDTH while prefixes outnumber them.
WIDTH, LEAST_WIDTH = 1 << 26, 1 << 16
PAGE = 1 << 12
#: Ids in one chunk of a member list.
CHUNK = 1 << 13
HEAD_TURNS, FAMILY = 9, 5

_LANES = ["lane0", "lane1", "lane2", "lane3"]
_DIGEST = ["p0", "p1"]
_EMPTY = hashlib.sha256(b"").hexdigest()


def numbered_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv, place, mark, bytes)``: places count from 1; ``mark`` is a digest of role and text."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    rows = turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"),
        F.sha2(text, 256).alias("text_mark"), F.octet_length(text).cast("bigint").alias("bytes"),
    )
    placed = running_totals(rows, ["conv"], ["turn", "role", "text_mark"], {"place": F.lit(1)})
    mark = F.sha2(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text_mark"), 256)
    return placed.select("conv", "place", mark.alias("mark"), "bytes")


def rebuilt(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations with a borrowed head: their turns ``(conv, place, mark, bytes)``, and ``(conv, length)`` of all.

    Conversation c takes the first h turns of c - c % 5, then its own after its first h, where
    h is the CRC-32 of c in decimal, modulo 9.
    """
    lengths = numbered.groupBy("conv").agg(F.count(F.lit(1)).alias("own"))
    head = (F.crc32(F.col("conv").cast("string")) % HEAD_TURNS).cast("bigint")
    plan = lengths.select("conv", "own", head.alias("head"), (F.col("conv") - F.col("conv") % FAMILY).alias("from"))
    lender = lengths.select(F.col("conv").alias("from"), F.col("own").alias("lent"))
    plan = plan.join(lender, "from", "left").withColumn("taken", F.least("head", F.coalesce("lent", F.lit(0))))
    plan = written(plan.withColumn("length", F.col("taken") + F.greatest(F.col("own") - F.col("head"), F.lit(0))), "trie-plan")
    first = numbered.filter(F.col("place") < HEAD_TURNS).withColumnRenamed("conv", "from")
    heads = first.join(plan.select("conv", "from", "head"), "from").filter(F.col("place") <= F.col("head"))
    own = numbered.join(plan.select("conv", "head", "taken"), "conv").filter(F.col("place") > F.col("head"))
    tails = own.select("conv", (F.col("taken") + F.col("place") - F.col("head")).alias("place"), "mark", "bytes")
    return heads.select("conv", "place", "mark", "bytes").unionByName(tails), plan.select("conv", "length")


def prefixes(turns: DataFrame) -> DataFrame:
    """``(conv, depth, p0, p1, q0, q1, bytes)``: digest of every prefix from depth 1 on, and of its parent."""
    whole = F.sha2(F.concat_ws(":", F.col("place").cast("string"), "mark"), 256)
    lanes = {f"own{i}": F.conv(F.substring(whole, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)}
    summed = running_totals(turns.withColumns(lanes), ["conv"], ["place"], {lane: F.col(f"own{i}") for i, lane in enumerate(_LANES)})

    def packed(a: Column, b: Column) -> Column:
        low = F.lit((1 << 32) - 1)
        return F.shiftleft(a.bitwiseAND(low), 32).bitwiseOR(b.bitwiseAND(low))

    now = [F.col(lane) for lane in _LANES]
    before = [F.col(lane) - F.col(f"own{i}") for i, lane in enumerate(_LANES)]
    return summed.select(
        "conv", F.col("place").alias("depth"), packed(*now[:2]).alias("p0"), packed(*now[2:]).alias("p1"),
        packed(*before[:2]).alias("q0"), packed(*before[2:]).alias("q1"), "bytes",
    )


def _slots(p0: np.ndarray, p1: np.ndarray, depth: np.ndarray, width: int) -> list[np.ndarray]:
    """A counter in each of the two rows; digests are even already."""
    with np.errstate(over="ignore"):
        turned = depth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return [((p.astype(np.int64).view(np.uint64) ^ turned) & np.uint64(width - 1)).astype(np.int64) for p in (p0, p1)]


def sketch_width(prefix_count: int, most: int = WIDTH) -> int:
    width = LEAST_WIDTH
    while width < min(2 * prefix_count, most):
        width *= 2
    return width


def shared_counters(rows: DataFrame, width: int) -> np.ndarray:
    """Two rows of ``width`` bits: counters of the count-min sketch that stand at two or more.

    Tasks count up to two and send pages; pages are added per place.
    """
    pages = -(-width // PAGE)

    def counted(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table: dict[int, np.ndarray] = {}
        for part in parts:
            for line, at in enumerate(_slots(part["p0"].to_numpy(), part["p1"].to_numpy(), part["depth"].to_numpy(), width)):
                places, n = np.unique(at, return_counts=True)
                page = places // PAGE + line * pages
                edges = np.flatnonzero(np.concatenate([[True], page[1:] != page[:-1]])) if len(page) else []
                for a, b in zip(edges, [*edges[1:], len(page)]):
                    own = table.setdefault(int(page[a]), np.zeros(PAGE, np.uint8))
                    inside = places[a:b] % PAGE
                    own[inside] = np.minimum(2, own[inside] + np.minimum(2, n[a:b]))
        yield pd.DataFrame({"page": list(table), "counts": [zlib.compress(t.tobytes(), 1) for t in table.values()]})

    def added(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(PAGE, np.uint16)
        for counts in group["counts"]:
            total = np.minimum(2, total + np.frombuffer(zlib.decompress(counts), np.uint8))
        return pd.DataFrame({"page": [group["page"].iloc[0]], "bits": [np.packbits(total > 1).tobytes()]})

    sent = rows.select("p0", "p1", "depth").mapInPandas(counted, "page bigint, counts binary")
    bits = np.zeros((2 * pages, PAGE // 8), np.uint8)
    for row in sent.groupBy("page").applyInPandas(added, "page bigint, bits binary").collect():
        bits[row["page"]] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return bits


def screened(rows: DataFrame, bits: np.ndarray, width: int) -> DataFrame:
    """Add ``alone``: the estimate is one, so the prefix is proven to be a singleton."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)
    pages = -(-width // PAGE)

    def alone(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            both = np.ones(len(part), bool)
            for line, at in enumerate(_slots(part["p0"].to_numpy(), part["p1"].to_numpy(), part["depth"].to_numpy(), width)):
                byte = shared.value[at // PAGE + line * pages, (at % PAGE) >> 3]
                both &= (byte >> (7 - (at & 7)) & 1).astype(bool)
            yield part.assign(alone=~both)

    schema = "conv bigint, depth bigint, p0 bigint, p1 bigint, q0 bigint, q1 bigint, bytes bigint"
    return rows.select("conv", "depth", "p0", "p1", "q0", "q1", "bytes").mapInPandas(alone, f"{schema}, alone boolean")


def end_hashes(ends: DataFrame) -> DataFrame:
    """``(p0, p1, depth, ends_sha256)`` of rows ``(p0, p1, depth, conv)``: the ids of a node in order, comma-joined.

    Ranges of (node, id) are joined into chunks side by side; a node's chunks are then hashed as
    they stream by, so neither a chunk's nor a node's list need fit anywhere as a whole.
    """
    node = ["p0", "p1", "depth"]
    chunked = "p0 bigint, p1 bigint, depth bigint, first bigint, ids string"

    def joined(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if part.empty:
                continue
            same = part.groupby(node, sort=False)
            number = same.cumcount() // CHUNK
            chunks = part.assign(ids=part["conv"].astype(str)).groupby([*node, number], sort=False)
            yield chunks.agg(first=("conv", "first"), ids=("ids", ",".join)).reset_index()[[*node, "first", "ids"]]

    def hashed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = None, None
        for part in parts:
            out = []
            for p0, p1, depth, _, ids in part.itertuples(index=False):
                if (p0, p1, depth) == at:
                    state.update(b"," + ids.encode())
                    continue
                if at is not None:
                    out.append((*at, state.hexdigest()))
                at, state = (p0, p1, depth), hashlib.sha256(ids.encode())
            yield pd.DataFrame(out, columns=[*node, "ends_sha256"])
        if at is not None:
            yield pd.DataFrame([(*at, state.hexdigest())], columns=[*node, "ends_sha256"])

    ordered = ends.select(*node, "conv").repartitionByRange(*node, "conv").sortWithinPartitions(*node, "conv")
    chunks = ordered.mapInPandas(joined, chunked).repartition(*[F.col(c) for c in node]).sortWithinPartitions(*node, "first")
    return chunks.mapInPandas(hashed, "p0 bigint, p1 bigint, depth bigint, ends_sha256 string")


def trie(turns: DataFrame, lengths: DataFrame, width: int | None = None) -> DataFrame:
    """The nodes of conversations given as ``(conv, place, mark, bytes)`` and ``(conv, length)`` of all, turnless ones too."""
    rows = written(prefixes(turns), "trie-prefixes")
    width = width or sketch_width(rows.count())
    flagged = written(screened(rows, shared_counters(rows, width), width), "trie-screened")
    anchors = flagged.filter("alone").groupBy("conv").agg(F.min("depth").alias("anchor"))
    convs = written(lengths.join(anchors, "conv", "left"), "trie-convs")
    dealt = flagged.drop("alone").join(convs, "conv")
    beyond = F.col("anchor").isNotNull() & (F.col("depth") > F.col("anchor"))

    last = F.col("depth") == F.col("length")
    whole = F.sha2(F.col("conv").cast("string"), 256)
    tails = dealt.filter(beyond).select(
        F.col("conv").alias("conv_id"), "depth", F.col("conv").alias("parent_conv_id"), F.lit(1).cast("bigint").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("bigint").alias("n_children"), F.lit(1).cast("bigint").alias("n_leaves"),
        F.lit(0).cast("bigint").alias("saved_tokens"), F.when(last, whole).otherwise(_EMPTY).alias("ends_sha256"),
    )

    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    roots = convs.select(
        "conv", zero.alias("depth"), zero.alias("p0"), zero.alias("p1"), none.alias("q0"), none.alias("q1"), zero.alias("bytes"), "length", "anchor"
    )
    near = written(dealt.filter(~beyond).unionByName(roots), "trie-shared")
    node = ["p0", "p1", "depth"]
    nodes = written(
        near.groupBy(*node).agg(
            F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.min("q0").alias("q0"), F.min("q1").alias("q1"),
            F.min("bytes").alias("bytes"),
            # An anchor that is not its conversation's end has its one child in the tail.
            F.max((F.col("depth") == F.col("anchor")) & (F.col("length") > F.col("depth"))).alias("has_tail"),
        ),
        "trie-nodes",
    )
    children = nodes.filter("depth > 0").groupBy("q0", "q1", (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("found"))
    children = children.withColumnsRenamed({"q0": "p0", "q1": "p1"})
    has_tail = F.coalesce(F.col("has_tail"), F.lit(False))
    grown = nodes.join(children, node, "left").withColumn(
        "n_children", F.coalesce("found", zero) + has_tail.cast("bigint")
    )
    grown = written(grown.withColumn("leaf", (has_tail | (F.col("n_children") == 0)).cast("bigint")).drop("found", "has_tail"), "trie-children")
    lent = grown.select(F.col("conv"), "depth", ((F.col("n_convs") - 1) * F.col("bytes")).alias("worth"), "leaf").filter("worth > 0 OR leaf > 0")
    deeper = running_totals(
        near.select("conv", *node).join(lent, ["conv", "depth"], "left"), ["conv"], ["-depth"],
        {"worth_below": F.col("worth"), "leaves_below": F.col("leaf")},
    )
    sums = deeper.groupBy(*node).agg(F.sum("worth_below").alias("saved_tokens"), F.sum("leaves_below").alias("n_leaves"))
    ends = end_hashes(near.filter(F.col("depth") == F.col("length")))
    parents = nodes.select(
        F.col("p0").alias("q0"), F.col("p1").alias("q1"), (F.col("depth") + 1).alias("depth"), F.col("conv").alias("parent_conv_id")
    )
    joined = grown.join(sums, node).join(ends, node, "left").join(parents, ["q0", "q1", "depth"], "left")
    return joined.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
    ).unionByName(tails)


def conversation_trie(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    width: int | None = None,
) -> DataFrame:
    """The trie of the rebuilt conversations, one row a node."""
    numbered = written(numbered_turns(conversations, conv_col, turn_col, role_col, text_col), "trie-turns")
    turns, lengths = rebuilt(numbered)
    return trie(turns, lengths, width)

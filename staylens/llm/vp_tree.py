"""Nearest neighbours by vantage-point trees, one a shard.

A shard is up to ``SHARD_ROWS`` consecutive vectors of an input partition, so the index is built
where the rows are, without a shuffle and whatever their keys are, once, and written: vectors in
tree order with the tree's nodes. Its tree splits on the
distance to a vantage point: the near half inside the median radius, the far half outside. A
query with current k-th distance t skips a half if the triangle inequality puts it further
away than t. ``factor`` relaxes this: the bound is multiplied by it first, so 1 is exact search
and larger factors skip more and may miss neighbours.

Shards are dealt to groups once. Queries travel to them in blocks (a stated query set against all
rows, in blocks): a task opens the trees of a group, then takes one block after the other past
them, so it never holds more than a group and a batch of blocks. The k-th distance that a
block has reached in one tree prunes the next. What is left are k rows for each query and group, cut by a
ranked window.

Defined results: rows without an id and vectors that are null, empty, zero or hold a null or
non-finite component take no part, and vectors of other length than the query's are no candidates; equal distances go to the
smaller id; rows that share the query's id are never its neighbours; repeated query rows count
once per different vector; fewer than k candidates give all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.common import written

SHARD_ROWS = 4096
LEAF_ROWS = 128
BLOCK_ROWS = 512
#: Shards that a task holds, and groups that a small index is dealt to all the same.
GROUP_SHARDS, LEAST_GROUPS = 16, 32
EXACT = 1.0
#: A stored node; its fields are those of :class:`Tree`.
NODE = np.dtype([("low", "<i8"), ("high", "<i8"), ("vantage", "<i8"), ("radius", "<f8"), ("inner", "<i8"), ("outer", "<i8")])


def usable(vector: Column) -> Column:
    """True for vectors that take part."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Euclidean, summed in the order of components, so that any caller gets the same doubles."""
    total = np.zeros(np.broadcast_shapes(points.shape[:-1], to.shape[:-1]))
    for i in range(points.shape[-1]):
        gap = points[..., i] - to[..., i]
        total += gap * gap
    return np.sqrt(total)


class Tree:
    """Rows in tree order and nodes ``(low, high, vantage row, radius, inner child, outer child)``; leaves have no vantage."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.points = ids[order], points[order]
        self.nodes: list[tuple] = []
        self.order = np.arange(len(ids))
        self._build(0, len(ids))
        self.ids, self.points = self.ids[self.order], self.points[self.order]

    def _build(self, low: int, high: int) -> int:
        at = len(self.nodes)
        self.nodes.append((low, high, -1, 0.0, -1, -1))
        if high - low > LEAF_ROWS:
            rows = self.order[low:high]
            points = self.points[rows]
            # The row furthest from the middle sees the others at the most different distances.
            pick = int(np.argmax(np.linalg.norm(points - points.mean(axis=0), axis=1)))
            rows[[0, pick]] = rows[[pick, 0]]
            far = np.linalg.norm(self.points[rows[1:]] - self.points[rows[0]], axis=1)
            by = np.argsort(far, kind="stable")
            half = len(by) // 2
            radius = float(far[by[half]])
            if far[by[0]] < far[by[-1]]:  # all alike cannot be split by distance; a leaf may be long then
                self.order[low], self.order[low + 1 : high] = rows[0], rows[1:][by]
                inner = self._build(low + 1, low + 1 + half)
                outer = self._build(low + 1 + half, high)
                self.nodes[at] = (low, high, low, radius, inner, outer)
        return at

    def pack(self) -> dict:
        return {**_packed(self.ids, self.points), "nodes": np.array(self.nodes, dtype=NODE).tobytes()}

    @classmethod
    def unpack(cls, row) -> Tree:
        tree = cls.__new__(cls)
        tree.ids, tree.points = _unpacked(row)
        tree.nodes = np.frombuffer(row.nodes, dtype=NODE).tolist()
        return tree


class Nearest:
    """The k best so far of a block of queries: by distance, then id."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, k: int):
        self.own, self.points, self.k = ids, points, k
        self.squares = (points * points).sum(axis=1)
        self.dist = np.full((len(ids), k), np.inf)
        self.ids = np.full((len(ids), k), np.iinfo(np.int64).max)

    def offer(self, rows: np.ndarray, ids: np.ndarray, points: np.ndarray) -> None:
        """Let ``rows`` see some points. A matrix product tells which may be near enough; only those are measured."""
        squares = (points * points).sum(axis=1)
        size = self.squares[rows][:, None] + squares[None, :]
        rough = size - 2 * (self.points[rows] @ points.T)
        worth = (rough <= np.square(self.dist[rows, -1:]) + 1e-9 * size) & (ids[None, :] != self.own[rows][:, None])
        some = worth.any(axis=1)
        rows, worth = rows[some], worth[some]
        if not len(rows):
            return
        found = np.full(worth.shape, np.inf)
        q, p = np.nonzero(worth)
        found[q, p] = distances(self.points[rows[q]], points[p])
        both = np.concatenate([self.dist[rows], found], axis=1)
        names = np.concatenate([self.ids[rows], np.broadcast_to(ids, found.shape)], axis=1)
        best = np.lexsort((names, both), axis=1)[:, : self.k]
        self.dist[rows] = np.take_along_axis(both, best, axis=1)
        self.ids[rows] = np.take_along_axis(names, best, axis=1)

    def _to(self, tree: Tree, rows: np.ndarray, vantage: int) -> np.ndarray:
        return np.linalg.norm(self.points[rows] - tree.points[vantage], axis=1)

    def search(self, tree: Tree, factor: float) -> int:
        """Search a whole block at once; returns how many query-point pairs were looked at.

        First every query sees the leaf it lies in, which makes its k-th distance small. Then
        the block walks the tree together, and queries drop out where the bound lets them.
        """
        everything = np.arange(len(self.own))
        first = np.empty(len(self.own), np.int64)
        stack = [(0, everything)]
        seen = 0
        while stack:
            at, rows = stack.pop()
            low, high, vantage, radius, inner, outer = tree.nodes[at]
            if vantage < 0:
                first[rows] = at
                self.offer(rows, tree.ids[low:high], tree.points[low:high])
                seen += len(rows) * (high - low)
                continue
            near = self._to(tree, rows, vantage) < radius
            stack += [(child, part) for child, part in ((inner, rows[near]), (outer, rows[~near])) if len(part)]
        walk = [(0, everything, np.zeros(len(everything)))]
        while walk:
            at, rows, bound = walk.pop()
            alive = bound * factor <= self.dist[rows, -1]
            rows, bound = rows[alive], bound[alive]
            if not len(rows):
                continue
            low, high, vantage, radius, inner, outer = tree.nodes[at]
            if vantage < 0:
                rows = rows[first[rows] != at]
                self.offer(rows, tree.ids[low:high], tree.points[low:high])
                seen += len(rows) * (high - low)
                continue
            self.offer(rows, tree.ids[vantage : vantage + 1], tree.points[vantage : vantage + 1])
            seen += len(rows)
            d = self._to(tree, rows, vantage)
            slack = 1e-9 * (d + radius)  # keeps rounding from skipping a half that holds an equal distance
            walk.append((inner, rows, np.maximum(bound, d - radius - slack)))
            walk.append((outer, rows, np.maximum(bound, radius - d - slack)))
        return seen


def _packed(ids: np.ndarray, points: np.ndarray) -> dict:
    return {"dim": points.shape[1], "ids": ids.astype("<i8").tobytes(), "points": points.astype("<f8").tobytes()}


def _unpacked(row) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row.ids, "<i8"), np.frombuffer(row.points, "<f8").reshape(-1, row.dim)


_PACK = "part int, n int, dim int, ids binary, points binary, nodes binary"


def _chunks(vectors: DataFrame, rows: int, indexed: bool) -> DataFrame:
    """Packs of up to ``rows`` vectors of one length, cut from each input partition in turn; with their tree if ``indexed``."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, n, held = TaskContext.get().partitionId(), 0, {}

        def flush(dim: int) -> pd.DataFrame:
            nonlocal n
            ids, points = zip(*held.pop(dim))
            ids, points = np.array(ids), np.stack(points)
            n += 1
            return pd.DataFrame([{"part": part, "n": n, **(Tree(ids, points).pack() if indexed else {**_packed(ids, points), "nodes": None})}])

        for batch in batches:
            for key, vector in zip(batch["id"], batch["vector"]):
                own = held.setdefault(len(vector), [])
                own.append((key, np.asarray(vector, dtype=np.float64)))
                if len(own) >= rows:
                    yield flush(len(vector))
        for dim in list(held):
            yield flush(dim)

    return vectors.mapInPandas(pack, _PACK)


def _sound(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.filter(F.col("id").isNotNull() & usable(F.col("vector")))


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The stored index: one row a shard."""
    return written(_chunks(_sound(vectors, id_col, vector_col), SHARD_ROWS, True), "vector-index")


def search_index(index: DataFrame, queries: DataFrame, k: int = 10, factor: float = EXACT, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest indexed rows for each row of ``queries``."""
    asked = _sound(queries, id_col, vector_col).distinct()
    blocks = written(_chunks(asked, BLOCK_ROWS, False), "query-blocks")
    count = index.count()
    groups = max(1, -(-count // GROUP_SHARDS), min(count, LEAST_GROUPS))
    own = F.pmod(F.xxhash64("part", "n"), F.lit(groups)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    rows = index.select(own.alias("group"), F.lit(0).alias("kind"), "*").unionByName(blocks.select(every.alias("group"), F.lit(1).alias("kind"), "*"))
    dealt = rows.repartition(groups, "group").sortWithinPartitions("group", "kind", "part", "n")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, trees = None, []
        for batch in batches:
            for row in batch.itertuples():
                if row.group != at:
                    at, trees = row.group, []
                if row.kind == 0:
                    trees.append(Tree.unpack(row))
                    continue
                ids, points = _unpacked(row)
                best = Nearest(ids, points, k)
                for tree in trees:
                    if tree.points.shape[1] == row.dim:
                        best.search(tree, factor)
                q, column = np.nonzero(np.isfinite(best.dist))
                if len(q):
                    tags = np.array([int.from_bytes(hashlib.blake2b(p.tobytes(), digest_size=8).digest(), "little", signed=True) for p in points])
                    yield pd.DataFrame({"query_id": ids[q], "tag": tags[q], "vec_id": best.ids[q, column], "score": best.dist[q, column]})

    near = dealt.mapInPandas(search, "query_id bigint, tag bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id", "tag").orderBy("score", "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("vec_id").alias(id_col), "score")


def neighbours(
    vectors: DataFrame, queries: DataFrame, k: int = 10, factor: float = EXACT,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest rows of ``vectors`` for each row of ``queries``."""
    return search_index(build_index(vectors, id_col, vector_col), queries, k, factor, id_col, vector_col)

"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most three bits have a point between them: one bit from one
and at most two from the other. So every fingerprint emits the points near it, and
fingerprints that emit the same point are candidates. Parity halves the work: flips change the
parity of a fingerprint, so at distance three one side is odd and the other even, and only odd
fingerprints emit two-bit variants. Of three bits two lie in the same half of the word, so only
two-bit variants within a half are needed. Together that is 64 points for an even fingerprint
and 1057 for an odd one, and no pair within distance three is missed.

Fingerprints that emit a point by at most one flip are all within three bits of everything
that emits it, so a point gives a star around one of them and never all pairs. Each link is
verified by counting bits. Components are found on distinct fingerprints by star contraction;
copies share a fingerprint and are only counted in at the end.

Defined results: null text counts as empty; a text with fewer words than a shingle is one
shingle of all its words, one without words has fingerprint 0, linked like any other; a null id
takes part but is never a component's name unless all its ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import fresh_name, written

SHINGLE = 3
RADIUS = 3
SEED = 42
CHUNK = 1 << 15
MEAN_VARIANTS = (64 + 1057) // 2
TASK_VARIANTS = 1 << 22
MAX_ROUNDS = 60


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


ONE_BIT = [_signed(1 << i) for i in range(64)]
TWO_BITS = [_signed(1 << a | 1 << b) for half in (range(32), range(32, 64)) for a, b in combinations(half, 2)]


def fingerprint(text: bytes | None, width: int = SHINGLE) -> int:
    """64 majority bits over the XXH64 of all shingles of white-space words, as a signed long."""
    import xxhash

    words = (text or b"").lower().split()  # for bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    if len(words) > width:
        hashes = [xxhash.xxh64_intdigest(line[a : b - 1], SEED) for a, b in zip([0, *ends], ends[width - 1 :])]
    else:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        block = np.array(hashes[at : at + CHUNK], dtype=">u8")
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">u8")[0].astype(np.int64))


def fingerprints(text: Column, width: int = SHINGLE) -> Column:
    @F.pandas_udf("bigint")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint(t, width) for t in batch], dtype="int64")

    return of(text.cast("binary"))


def _constants(values: list[int]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def variants(distinct: DataFrame) -> DataFrame:
    """``(point, fp)``: the points each fingerprint has to emit."""
    odd = F.bit_count("fp") % 2 == 1
    flips = F.when(odd, _constants([0, *ONE_BIT, *TWO_BITS])).otherwise(_constants(ONE_BIT))
    return distinct.select("fp", F.explode(flips).alias("flip")).select(F.col("fp").bitwiseXOR(F.col("flip")).alias("point"), "fp")


def _stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links from rows sorted by point; a point's rows may go on in the next batch.

    At most 64 + 1 + 992 fingerprints can emit a point, so what is carried over is small.
    """
    point, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def links(point: np.ndarray, fp: np.ndarray) -> pd.DataFrame:
        again = np.zeros(len(point), bool)
        again[1:] = point[1:] == point[:-1]
        busy = again.copy()
        busy[:-1] |= again[1:]
        p, f, first = point[busy], fp[busy], ~again[busy]
        group = np.cumsum(first) - 1
        if not len(p):
            return pd.DataFrame({"a": p, "b": p})
        near = np.bitwise_count((p ^ f).view(np.uint64)) <= 1
        hub = np.full(group[-1] + 1, np.iinfo(np.int64).max)
        np.minimum.at(hub, group[near], f[near])
        has = np.zeros(group[-1] + 1, bool)
        has[group[near]] = True
        a = hub[group]
        ok = has[group] & (a != f) & (np.bitwise_count((a ^ f).view(np.uint64)) <= RADIUS)
        pairs = np.unique(np.stack([np.minimum(a, f)[ok], np.maximum(a, f)[ok]], axis=1), axis=0)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    for batch in batches:
        if not len(batch):
            continue
        point = np.concatenate([point, batch["point"].to_numpy()])
        fp = np.concatenate([fp, batch["fp"].to_numpy()])
        done = int(np.searchsorted(point, point[-1], "left"))
        yield links(point[:done], fp[:done])
        point, fp = point[done:], fp[done:]
    if len(point):
        yield links(point, fp)


def links(distinct: DataFrame) -> DataFrame:
    """Verified links ``(a, b)``, ``a < b``, that connect all fingerprints within the radius."""
    # Few rows become very many here, so the number of tasks follows their number and not the bytes read.
    spark, count = distinct.sparkSession, distinct.count()
    emit = max(spark.sparkContext.defaultParallelism, -(-count * MEAN_VARIANTS // TASK_VARIANTS))
    meet = max(int(spark.conf.get("spark.sql.shuffle.partitions")), emit)
    met = variants(distinct.repartition(emit, "fp")).repartition(meet, "point").sortWithinPartitions("point")
    return met.mapInPandas(_stars, "a bigint, b bigint").distinct()


def contract(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``: its component's smallest node.

    Alternates large and small stars: each node hands its larger, then its smaller neighbours
    to the smallest one it knows. Only minima are grouped, so a node with very many
    neighbours costs one row per task. Each round is a written table.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "components")
    for _ in range(MAX_ROUNDS):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("u", "m").alias("m"))
        large = both.filter(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("_u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "_u")
        small = large.join(down, F.col("u") == F.col("_u")).filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(down.select(F.col("_u").alias("u"), F.col("m").alias("v"))).distinct()
        new = written(small, "components")
        # Done when every node hangs on one root that hangs on nothing.
        roots = new.select(F.col("v").alias("_v")).distinct()
        deep = new.join(roots, F.col("u") == F.col("_v"), "left_semi").limit(1).count()
        several = new.groupBy("u").agg(F.count("*").alias("n")).filter(F.col("n") > 1).limit(1).count()
        edges = new
        if not deep and not several:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _prints(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    text = F.col(text_col)
    return written(docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"), fingerprints(text, width).alias("fp")), "fingerprints")


def _roots(prints: DataFrame) -> DataFrame:
    """``(_fp, root, component_id)``, one row a distinct fingerprint."""
    names = written(prints.groupBy("fp").agg(F.min("id").alias("id")), "distinct-fingerprints")
    roots = contract(links(names.select("fp")))
    named = names.join(roots, names["fp"] == roots["node"], "left").select("fp", "id", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    return written(named.select(F.col("fp").alias("_fp"), "root").join(least, "root"), "component-names")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """``(id, fp, component_id)``, one row a row of ``docs``."""
    prints = _prints(docs, id_col, text_col, width)
    table = _roots(prints)
    return prints.join(table, F.col("fp") == F.col("_fp")).select(F.col("id").alias(id_col), "fp", "component_id")


def hex_print(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """Rows of ``docs``, one of each group: that with the smallest id (a null one last).

    Of rows equal in id and text one stays. Candidates are found on ids and hashes alone; the
    texts meet the kept keys once, at the end.
    """
    prints = _prints(docs, id_col, text_col, width)
    rows = prints.join(_roots(prints), F.col("fp") == F.col("_fp"))
    alike = rows.groupBy("root", "id", "hash").agg(F.count("*").alias("n"))
    first = alike.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "hash", "n")).alias("first"))
    key, hash_, n = (fresh_name(docs, x) for x in ("_key", "_hash", "_n"))
    kept = written(first.select(F.col("first.id").alias(key), F.col("first.hash").alias(hash_), F.col("first.n").alias(n)), "kept-keys")
    met = docs.join(kept, F.col(id_col).eqNullSafe(F.col(key)) & (F.xxhash64(text_col) == F.col(hash_)))
    once = met.filter(F.col(n) == 1).select(*docs.columns)
    repeated = met.filter(F.col(n) > 1).dropDuplicates([key, hash_]).select(*docs.columns)
    return once.unionByName(repeated)

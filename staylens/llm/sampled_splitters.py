"""Shards of nearly equal bytes by sampled splitters.

Keys are ordered by (hash of the text, hash of the id), so copies of a text lie together and
yet can be parted. A sample that takes rows in proportion to their size gives quantile
boundaries of fine ranges; every row is put into its range, the ranges are weighed exactly, and
a range that turned out overfull is sampled again and subdivided, and one that rows equal in id and
text fill is cut by their number. Whole ranges are then dealt to the shards in order.

Only the sample (``samples_per_range`` keys a range), the boundaries and the range totals reach the driver;
their number depends on the number of ranges, not on the data.

Defined results: null text has size 1; rows equal in id and text are interchangeable, take
neighbouring slots and may lie in several shards; empty shards occur only where there are too few rows; an empty table gives
no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.common import written
from staylens.operators.scan import running_totals

RANGES_PER_SHARD = 256
SAMPLES_PER_RANGE = 16
#: A range is overfull above this multiple of its fair share.
OVERFULL = 2.0
#: Overfull ranges are sampled again so many times as densely, until none is left that can be parted.
RESAMPLE = 4


def byte_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def _sample(keyed: DataFrame, rate: float, turn: int = 0) -> pd.DataFrame:
    """Keys drawn with chance min(1, size * rate), by a hash of the key and, if there is one, the row's place ``e``.

    A row for which size * rate exceeds 1 counts as that many draws.
    """
    chance = F.col("size") * F.lit(rate)
    place = ["e"] if "e" in keyed.columns else []
    draw = F.shiftrightunsigned(F.xxhash64("k", "d", *place, F.lit(turn)), 11) / F.lit(float(1 << 53))
    drawn = keyed.filter(draw < chance).select("k", "d", F.greatest(chance, F.lit(1.0)).alias("w"))
    return drawn.toPandas().sort_values(["k", "d"], ignore_index=True)


def _next_key(key: tuple[int, int]) -> tuple[int, int]:
    k, d = key
    return (k, d + 1) if d < (1 << 63) - 1 else (k + 1, -(1 << 63))


def _quantiles(sample: pd.DataFrame, ranges: int) -> list[tuple[int, int]]:
    """About ``ranges - 1`` boundary keys; a key equal to a boundary lies above it.

    A key that is picked more than once fills ranges of its own, so the next key is a boundary too.
    """
    if sample.empty:
        return []
    upto = np.cumsum(sample["w"].to_numpy())
    at = np.searchsorted(upto, upto[-1] * np.arange(1, ranges) / ranges)
    picked = sample.iloc[at]
    times = Counter(zip(picked["k"].tolist(), picked["d"].tolist()))
    return sorted({*times, *[_next_key(key) for key, n in times.items() if n > 1]})


def _with_range(keyed: DataFrame, splitters: list[tuple[int, int]]) -> DataFrame:
    """Add ``range``: how many splitters are at or below the key."""
    ks = np.array([k for k, _ in splitters], dtype=np.int64)
    ds = np.array([d for _, d in splitters], dtype=np.int64)

    @F.pandas_udf("int")
    def range_of(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for k, d in parts:
            k, d = k.to_numpy(), d.to_numpy()
            low, high = np.searchsorted(ks, k, "left"), np.searchsorted(ks, k, "right")
            for key in np.unique(k[low < high]):  # keys that are parted by their second half
                rows = np.flatnonzero(k == key)
                a, b = low[rows[0]], high[rows[0]]
                low[rows] = a + np.searchsorted(ds[a:b], d[rows], "right")
            yield pd.Series(low.astype(np.int32))

    return keyed.withColumn("range", range_of("k", "d"))


def _weigh(keyed: DataFrame, splitters: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and rows of every range."""
    rows = _with_range(keyed, splitters).groupBy("range").agg(F.sum("size").alias("s"), F.count("*").alias("n")).collect()
    size, count = np.zeros(len(splitters) + 1, np.int64), np.zeros(len(splitters) + 1, np.int64)
    for r in rows:
        size[r["range"]], count[r["range"]] = r["s"], r["n"]
    return size, count


def _one_key(splitters: list[tuple[int, int]]) -> np.ndarray:
    """For each range, whether it can hold one key only."""
    alone = [False, *[_next_key(a) == b for a, b in zip(splitters, splitters[1:])], False]
    return np.array(alone[: len(splitters) + 1])


def find_splitters(keyed: DataFrame, ranges: int, samples: int = SAMPLES_PER_RANGE) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
    """Boundaries of about ``ranges`` ranges of rows ``(k, d, size)``, with each range's bytes and rows.

    Afterwards only ranges of a single key, or of a single row, may be overfull.
    """
    total = keyed.agg(F.sum("size")).first()[0] or 0
    if not total:
        return [], np.zeros(1, np.int64), np.zeros(1, np.int64)
    splitters = _quantiles(_sample(keyed, ranges * samples / total), ranges)
    size, count = _weigh(keyed, splitters)
    fair, dense, turn = total / ranges, RESAMPLE, 0
    while len(over := np.flatnonzero((size > OVERFULL * fair) & (count > 1) & ~_one_key(splitters))):
        turn += 1
        inside = _with_range(keyed, splitters).filter(F.col("range").isin([int(x) for x in over])).drop("range")
        drawn = _sample(inside, dense * samples / fair, turn)
        more = set(_quantiles(drawn, 4 * int(np.ceil(size[over].sum() / fair)))) - set(splitters)
        if more:
            splitters = sorted([*splitters, *more])
            size, count = _weigh(keyed, splitters)
        else:
            dense *= RESAMPLE
            if dense > RESAMPLE * fair / samples:  # every row has been drawn
                break
    return splitters, size, count


def sharded(
    docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
    ranges_per_shard: int = RANGES_PER_SHARD,
) -> DataFrame:
    """``(id, size, text_crc32, shard, slot)``: shards of nearly equal bytes, slots without gaps in key order.

    Ranges, not shards, are the unit of work when slots are counted, so no task holds a shard. An
    overfull range of one key holds rows that nothing tells apart: they are numbered over all of
    them and cut into stretches of a fair range's bytes.
    """
    spark = docs.sparkSession
    keyed = written(
        docs.select(
            F.col(id_col), byte_size(F.col(text_col)).alias("size"),
            F.coalesce(F.crc32(F.col(text_col)), F.lit(0)).cast("bigint").alias("text_crc32"),
            F.xxhash64(F.col(text_col)).alias("k"), F.xxhash64(F.col(id_col).cast("string")).alias("d"),
            F.monotonically_increasing_id().alias("e"),
        ),
        "shard-keys",
    )
    ranges = shards * ranges_per_shard
    splitters, size, count = find_splitters(keyed.select("k", "d", "e", "size"), ranges)
    total = max(1, int(size.sum()))
    hot = (size > OVERFULL * total / ranges) & (count > 1) & _one_key(splitters)
    units, steps = [], []  # (range, stretch, rows, bytes) in order; (range, rows of a stretch)
    for i, (n, s) in enumerate(zip(count.tolist(), size.tolist())):
        step = max(1, int(total / ranges * n / s)) if hot[i] else max(1, n)
        if hot[i]:
            steps.append((i, step))
        units += [(i, j, min(step, n - j * step), s / n * min(step, n - j * step)) for j in range(-(-n // step))]
    weights = np.array([u[3] for u in units] or [0.0])
    shard = np.minimum(shards - 1, ((np.cumsum(weights) - weights / 2) * shards / total).astype(np.int64))
    placed, taken = [], Counter()
    for (i, j, n, _), s in zip(units, shard.tolist()):
        placed.append((i, j, s, taken[s]))
        taken[s] += n
    places = spark.createDataFrame(placed, "range int, stretch bigint, shard int, first_slot bigint")
    ranged = _with_range(keyed, splitters)
    order = Window.partitionBy("range").orderBy("k", "d", "e")
    names = [id_col, "size", "text_crc32", "range"]
    plain = ranged.filter(~F.col("range").isin([i for i, _ in steps])) if steps else ranged
    zero = F.lit(0).cast("bigint")
    numbered = plain.withColumns({"stretch": zero, "row": F.row_number().over(order) - 1}).select(*names, "stretch", "row")
    if steps:
        cut = spark.createDataFrame(steps, "range int, step bigint")
        inside = ranged.join(F.broadcast(cut), "range").select(*names, "step")
        nth = running_totals(inside, ["range"], [], {"nth": F.lit(1)})
        at = F.col("nth") - 1
        numbered = numbered.unionByName(nth.select(*names, F.floor(at / F.col("step")).alias("stretch"), (at % F.col("step")).alias("row")))
    return numbered.join(places, ["range", "stretch"]).select(
        id_col, "size", "text_crc32", "shard", (F.col("first_slot") + F.col("row")).alias("slot")
    )

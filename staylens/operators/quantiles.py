"""Quantiles, outlier bounds, box statistics and histograms."""

from __future__ import annotations

import math
import struct
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_GRID = [i / 200 for i in range(201)]
_ACCURACY = 10_000


def _place(value: float) -> int:
    """Doubles in order as whole numbers, infinities included: neighbours differ by 1."""
    bits = struct.unpack("<q", struct.pack("<d", value + 0.0))[0]
    return bits if bits >= 0 else -(bits & 0x7FFF_FFFF_FFFF_FFFF)


def _double(place: int) -> float:
    return struct.unpack("<d", struct.pack("<q", place if place >= 0 else -place | -(1 << 63)))[0]


@dataclass
class _Target:
    """One order statistic: the value at 0-based ``rank`` of ``column``.

    It is known to lie in [low, high]; ``below`` rows are smaller than ``low``,
    ``inside`` rows lie in the range and have about ``distinct`` different values.
    ``grid`` holds approximate quantiles of the rows inside, once a pass took them.
    """

    column: str
    rank: int
    low: float
    high: float
    below: int
    inside: int
    distinct: int
    grid: list[float] | None = None

    @property
    def found(self) -> bool:
        return self.low == self.high

    def proposal(self) -> tuple[float, float]:
        """The range the next pass should count: all of it if nothing is known yet."""
        if not self.grid:
            return self.low, self.high
        at = (self.rank - self.below) / max(self.inside, 1) * (len(self.grid) - 1)
        low = self.grid[max(0, math.floor(at) - 1)]
        high = self.grid[min(len(self.grid) - 1, math.ceil(at) + 1)]
        if (low, high) != (self.low, self.high):
            return low, high
        # Few values hold most rows: halve the range instead, counted in doubles, which always ends.
        return self.low, _double((_place(self.low) + _place(self.high)) // 2)


def _clean(name: str) -> Column:
    """Floating value with NaN read as null."""
    column = F.col(name).cast("double")
    return F.when(~F.isnan(column), column)


def _narrow(df: DataFrame, targets: list[_Target]) -> None:
    """One pass that shrinks the range of every open target."""
    proposals, aggregates = [], []
    for i, t in enumerate(targets):
        low, high = t.proposal()
        v = _clean(t.column)
        inside = (v >= low) & (v <= high)
        aggregates += [
            F.count_if(v < low).alias(f"lt_low{i}"),
            F.count_if(v <= high).alias(f"le_high{i}"),
            F.approx_count_distinct(F.when(inside, v)).alias(f"distinct{i}"),
            F.percentile_approx(F.when(inside, v), _GRID, _ACCURACY).alias(f"grid{i}"),
        ]
        proposals.append((low, high))
    row = df.agg(*aggregates).first()
    for i, (t, (low, high)) in enumerate(zip(targets, proposals)):
        lt_low, le_high = row[f"lt_low{i}"], row[f"le_high{i}"]
        if t.rank < lt_low:
            t.high, t.inside, t.grid = _double(_place(low) - 1), lt_low - t.below, None
        elif t.rank >= le_high:
            t.inside -= le_high - t.below
            t.low, t.below, t.grid = _double(_place(high) + 1), le_high, None
        else:
            t.low, t.high, t.below = low, high, lt_low
            t.inside, t.grid = le_high - lt_low, row[f"grid{i}"]
            t.distinct = row[f"distinct{i}"]


def _resolve(df: DataFrame, targets: list[_Target]) -> dict[tuple[str, int], float]:
    """Read each value off the sorted distinct values of its (now small) range."""
    answer = {(t.column, t.rank): t.low for t in targets if t.found}
    slices: dict[tuple, list[_Target]] = {}
    for t in targets:
        if not t.found:
            slices.setdefault((t.column, t.low, t.high, t.below), []).append(t)
    if not slices:
        return answer
    entries, wanted = [], []
    for i, ((column, low, high, below), members) in enumerate(slices.items()):
        v = _clean(column)
        entries.append(F.when((v >= low) & (v <= high), v).alias(str(i)))
        ranks = [F.lit(t.rank - below).cast("bigint") for t in members]
        wanted += [F.lit(i), F.array(*ranks)]
    # An array of all entries, exploded, is a method too long to be compiled once there are many columns.
    counted = (
        df.select(*entries)
        .unpivot([], [str(i) for i in range(len(entries))], "slice", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("slice", "value")
        .count()
        .withColumn("slice", F.col("slice").cast("int"))
    )
    upto = Window.partitionBy("slice").orderBy("value")
    running = counted.withColumn("upto", F.sum("count").over(upto))
    reached = running.select("*", F.explode(F.create_map(*wanted)[F.col("slice")]).alias("rank")).filter(
        F.col("upto") > F.col("rank")
    )
    keys = list(slices)
    for row in reached.groupBy("slice", "rank").agg(F.min("value").alias("value")).collect():  # one row per target
        column, _, _, below = keys[row["slice"]]
        answer[(column, row["rank"] + below)] = row["value"]
    return answer


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    method: str = "linear",
    finish_distinct: int = 1_000_000,
) -> DataFrame:
    """Exact quantiles as rows (column, probability, n, value); nulls and NaN are left out.

    The built-in exact percentile keeps every distinct value of a column in one task.
    Here a first scan counts; a column with at most ``finish_distinct`` distinct values
    (about) is then grouped by value and its running counts are read off. For a wider
    column a quantile sketch first brackets each wanted rank, a scan counts what lies
    below the bracket, and this repeats until the bracket is small enough. A bracket
    keeps about 2 % of its rows per pass, so even very large columns need few scans.

    ``linear`` interpolates between neighbours, ``rank`` takes the first value whose
    cumulative share reaches the probability.
    """
    first = df.agg(
        *[
            a
            for i, c in enumerate(columns)
            for a in (
                F.count(_clean(c)).alias(f"n{i}"),
                F.min(_clean(c)).alias(f"lo{i}"),
                F.max(_clean(c)).alias(f"hi{i}"),
                F.approx_count_distinct(_clean(c)).alias(f"d{i}"),
            )
        ]
    ).first()

    targets: dict[tuple[str, int], _Target] = {}
    wanted = []
    for i, c in enumerate(columns):
        n = first[f"n{i}"]
        for p in probabilities:
            if n == 0:
                wanted.append((c, p, 0, None))
                continue
            if method == "linear":
                position = (n - 1) * p
                low_rank, high_rank = math.floor(position), math.ceil(position)
            else:
                position = low_rank = high_rank = max(1, math.ceil(n * p - 1e-9)) - 1
            for rank in (low_rank, high_rank):
                targets.setdefault(
                    (c, rank),
                    _Target(c, rank, first[f"lo{i}"], first[f"hi{i}"], 0, n, first[f"d{i}"]),
                )
            wanted.append((c, p, n, (low_rank, high_rank, position - low_rank)))

    every = list(targets.values())
    while wide := [t for t in every if not t.found and t.distinct > finish_distinct]:
        _narrow(df, wide)
    value = _resolve(df, every)

    rows = []
    for c, p, n, where in wanted:
        if where is None:
            rows.append((c, float(p), 0, None))
            continue
        low_rank, high_rank, share = where
        low, high = value[(c, low_rank)], value[(c, high_rank)]
        # Equal neighbours need no step between them, and infinities have none.
        between = low if low == high or share == 0 else low + (high - low) * share
        rows.append((c, float(p), n, between))
    return df.sparkSession.createDataFrame(
        rows, "column string, probability double, n bigint, value double"
    )


def with_quartiles(summary: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill ``p25``, ``p50`` and ``p75`` of a summary of ``df`` exactly, as values that occur."""
    exact = exact_quantiles(df, columns, [0.25, 0.5, 0.75], method="rank")
    names = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    wide = exact.groupBy(F.col("column").alias("_column")).agg(
        *[F.max(F.when(F.col("probability") == p, F.col("value"))).alias(f"_{n}") for n, p in names.items()]
    )
    joined = summary.join(wide, F.col("column") == F.col("_column"), "left")
    return joined.select(*[F.col(f"_{c}").alias(c) if c in names else c for c in summary.columns])


def iqr_bounds(
    df: DataFrame,
    columns: Sequence[str],
    k: float = 1.5,
    relative_error: float = 0.01,
    exact: bool = False,
) -> DataFrame:
    """Quartiles and the fences ``q1 - k*iqr`` and ``q3 + k*iqr`` per column.

    All columns share one scan. ``exact`` uses :func:`exact_quantiles`.
    """
    if exact:
        quartiles = exact_quantiles(df, columns, [0.25, 0.75]).groupBy("column").agg(
            F.max(F.when(F.col("probability") == 0.25, F.col("value"))).alias("q1"),
            F.max(F.when(F.col("probability") == 0.75, F.col("value"))).alias("q3"),
        )
    else:
        accuracy = math.ceil(1 / relative_error)
        row = df.agg(
            *[F.percentile_approx(_clean(c), [0.25, 0.75], accuracy).alias(f"q{i}") for i, c in enumerate(columns)]
        )
        quartiles = row.select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(c).alias("column"),
                            F.col(f"q{i}")[0].alias("q1"),
                            F.col(f"q{i}")[1].alias("q3"),
                        )
                        for i, c in enumerate(columns)
                    ]
                )
            )
        )
    iqr = F.round(F.col("q3") - F.col("q1"), 4)
    return quartiles.select(
        "column", "q1", "q3", iqr.alias("iqr"),
        (F.col("q1") - k * iqr).alias("lower_bound"),
        (F.col("q3") + k * iqr).alias("upper_bound"),
    )


def box_stats(df: DataFrame, column: str, k: float = 1.5) -> DataFrame:
    """What a box plot draws: quartiles, whiskers (last value inside the fence), outliers."""
    quartiles = {
        r["probability"]: r["value"]
        for r in exact_quantiles(df, [column], [0.25, 0.5, 0.75]).collect()  # three rows
    }
    q1, q2, q3 = quartiles[0.25], quartiles[0.5], quartiles[0.75]
    v = _clean(column)
    if q1 is None:
        low_fence = high_fence = None
    else:
        low_fence, high_fence = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
    low, high = F.lit(low_fence).cast("double"), F.lit(high_fence).cast("double")
    first, third = F.lit(q1).cast("double"), F.lit(q3).cast("double")
    return df.agg(
        F.count(v).alias("n"),
        F.min(F.when(v >= low, v)).alias("lowest_inside"),
        F.max(F.when(v <= high, v)).alias("highest_inside"),
        F.count_if(v < low).alias("outliers_low"),
        F.count_if(v > high).alias("outliers_high"),
    ).select(
        "n",
        first.alias("q1"),
        F.lit(q2).cast("double").alias("median"),
        third.alias("q3"),
        F.least("lowest_inside", first).alias("whisker_low"),
        F.greatest("highest_inside", third).alias("whisker_high"),
        "outliers_low",
        "outliers_high",
    )


def clipped_histogram(
    df: DataFrame, column: str, low: float, high: float, bins: int
) -> DataFrame:
    """Equal-width counts after clipping to [low, high]; empty bins are listed with 0.

    The last bin is closed, so it also holds everything at or above ``high``.
    """
    width = (high - low) / bins
    v = F.col(column)
    clipped = F.least(F.greatest(v, F.lit(float(low))), F.lit(float(high)))
    bin_index = F.least(F.floor((clipped - low) / width), F.lit(bins - 1))
    counted = (
        df.filter(v.isNotNull() & ~F.isnan(v))
        .groupBy(bin_index.cast("bigint").alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    axis = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return axis.join(counted, "bin", "left").select(
        "bin",
        (F.lit(float(low)) + F.col("bin") * width).alias("bin_start"),
        (F.lit(float(low)) + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )

"""Running totals, ranks and previous values over groups of any size, or over the whole table.

A plain window puts a whole group into one task, and without a partition all rows. Here the
rows are put in order into ranges, which are of like size whatever the keys. Every range is
scanned for itself, its totals (one row a range and key) are added up, and what the earlier
ranges of a key hold is carried into the later ones. A key that lies in one range only, as
nearly all do, carries nothing, so the carried rows are fewer than the ranges and go to every
task.

An order is a list of column names; ``-name`` is descending. Nulls come first in an ascending
order and last in a descending one.

Rows that agree in key and order differ by a row number written with them: a large group of
equal rows is spread like any other. A null key is a key like any other. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.session import settled

_BLOCK, _TIE = "_scan_block", "_scan_tie"


def _sorted_by(order: Sequence[str], turned: bool = False) -> list[Column]:
    """Sort columns of an order, or of its exact reverse."""
    columns = []
    for item in order:
        name, down = item.removeprefix("-"), item.startswith("-")
        columns.append(F.desc_nulls_last(name) if down != turned else F.asc_nulls_first(name))
    return columns


def _in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` written in ranges of (keys, order), with the range's number and a row number that parts equal rows."""
    numbered = settled(df.withColumn(_TIE, F.monotonically_increasing_id()), "scan-rows")
    ranged = numbered.repartitionByRange(*[F.col(k) for k in keys], *_sorted_by([*order, _TIE]))
    return settled(ranged.withColumn(_BLOCK, F.spark_partition_id()), "scan-ranges")


def _window(keys: Sequence[str], order: Sequence[str], turned: bool = False):
    return Window.partitionBy(_BLOCK, *keys).orderBy(*_sorted_by([*order, _TIE], turned))


def _same(left: DataFrame, right: DataFrame, names: Mapping[str, str]) -> Column:
    test = F.lit(True)
    for name, other in names.items():
        test = test & left[name].eqNullSafe(right[other])
    return test


def _with_carry(rows: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of ``carry``, which has fewer rows than there are ranges, by range and key."""
    renamed = {k: f"_carry_{i}" for i, k in enumerate([_BLOCK, *keys])}
    carry = carry.withColumnsRenamed(renamed)
    return rows.join(F.broadcast(carry), _same(rows, carry, renamed), "left")


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[str], totals: Mapping[str, Column]) -> DataFrame:
    """Add running sums of integers (this row included) per key in ``order``.

    ``totals`` maps new names to what is summed; ``F.lit(1)`` numbers the rows. Nulls add nothing.
    """
    zero = F.lit(0).cast("bigint")
    values = {f"_scan_{i}": F.coalesce(v.cast("bigint"), zero) for i, v in enumerate(totals.values())}
    rows = _in_ranges(df.withColumns(values), keys, order)
    inside = _window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(_BLOCK, *keys).agg(*[F.sum(v).alias(v) for v in values])
    first = list(values)[0]
    carry = sums.select(_BLOCK, *keys, *[F.sum(v).over(earlier).alias(f"{v}_carry") for v in values])
    carry = carry.filter(F.col(f"{first}_carry").isNotNull())  # null in the first range of a key
    joined = _with_carry(rows.withColumns({v: F.sum(v).over(inside) for v in values}), carry, keys)
    found = [(F.col(v) + F.coalesce(F.col(f"{v}_carry"), zero)).alias(name) for name, v in zip(totals, values)]
    return joined.select(*df.columns, *found)


def previous_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """Add ``value`` of the row before, per key in ``order``; null for the first row of a key."""
    rows = _in_ranges(df, keys, order)
    inside = _window(keys, order)
    local = rows.withColumns(
        {"_scan_first": F.row_number().over(inside) == 1, "_scan_before": F.lag(value).over(inside)}
    )
    ends = rows.withColumn("_scan_nth", F.row_number().over(_window(keys, order, turned=True)))
    across = Window.partitionBy(*keys).orderBy(_BLOCK)
    carry = ends.filter(F.col("_scan_nth") == 1).select(
        _BLOCK, *keys, F.row_number().over(across).alias("_scan_nth"), F.lag(value).over(across).alias("_scan_carry")
    )
    joined = _with_carry(local, carry.filter(F.col("_scan_nth") > 1).drop("_scan_nth"), keys)
    found = F.when(F.col("_scan_first"), F.col("_scan_carry")).otherwise(F.col("_scan_before"))
    return joined.select(*df.columns, found.alias(name))


def ranks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rank: str | None = "rank", dense_rank: str | None = None
) -> DataFrame:
    """Add rank and dense rank of each row's ``order`` values within its key; equal values rank alike.

    Values are counted before they are scanned, so a value that many rows share is one row of the
    scan, and its rows get their rank by a join.
    """
    names = [*keys, *[item.removeprefix("-") for item in order]]
    counted = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_scan_rows"))
    scanned = running_totals(counted, keys, order, {"_scan_upto": F.col("_scan_rows"), "_scan_dense": F.lit(1)})
    other = {c: f"_rank_{i}" for i, c in enumerate(names)}
    scanned = scanned.withColumnsRenamed(other)
    joined = df.join(scanned, _same(df, scanned, other))
    new = []
    if rank:
        new.append((F.col("_scan_upto") - F.col("_scan_rows") + 1).alias(rank))
    if dense_rank:
        new.append(F.col("_scan_dense").alias(dense_rank))
    return joined.select(*[df[c] for c in df.columns], *new)

"""Small helpers the operators share."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.session import scratch_dir

#: One word: a run of anything but the six ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends here and every later read sees the same rows."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet, whatever the case."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def worker_state() -> types.ModuleType:
    """A place that lives as long as the Python worker, for tables that are costly to build."""
    return sys.modules.setdefault("_staylens_worker_state", types.ModuleType("_staylens_worker_state"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often the body names it.

    Projections may be merged, and then an array that a lambda refers to would be built anew
    for each element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def positions(sizes: Column, block: int = 64) -> Column:
    """Sum of all earlier elements, for each element of an array of longs; in two levels, so long arrays stay cheap."""
    zero = F.lit(0).cast("bigint")

    def total(values: Column) -> Column:
        return F.aggregate(values, zero, lambda acc, x: acc + x)

    def upto(values: Column) -> Column:
        return F.transform(values, lambda _, i: total(F.slice(values, 1, i)))

    def blocks(values: Column) -> Column:
        last = F.floor((F.size(values) - 1) / block).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(values, b * block + 1, block))

    def joined(parts: Column) -> Column:
        return let(
            F.transform(parts, total),
            lambda sums: let(
                upto(sums),
                lambda before: F.flatten(F.zip_with(parts, before, lambda part, off: F.transform(upto(part), lambda x: x + off))),
            ),
        )

    return F.when(F.size(sizes) == 0, F.array().cast("array<bigint>")).otherwise(let(blocks(sizes), joined))

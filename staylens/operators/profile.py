"""Data profiling. Every report is one pass over the data, whatever its column count."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.functions import MISSING_TOKENS, is_missing
from staylens.session import settled


def _one_row_to_long(row: DataFrame, entries: Sequence[Column]) -> DataFrame:
    """Turn a one-row aggregate into one row per entry (``entries`` are structs)."""
    return row.select(F.inline(F.array(*entries)))


def missing_profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    tokens: Iterable[str] = MISSING_TOKENS,
    keep_complete: bool = False,
) -> DataFrame:
    """Missing and valid counts per column, most affected first."""
    tokens = tuple(tokens)
    dtypes = dict(df.dtypes)
    names = list(columns or df.columns)
    counts = [
        F.count_if(is_missing(name, dtypes[name], tokens)).alias(f"m{i}")
        for i, name in enumerate(names)
    ]
    row = df.agg(F.count(F.lit(1)).alias("n"), *counts)
    long = _one_row_to_long(
        row,
        [
            F.struct(
                F.lit(name).alias("column"),
                F.col(f"m{i}").alias("missing"),
                (F.col("n") - F.col(f"m{i}")).alias("valid"),
                F.try_divide(F.col(f"m{i}") * F.lit(100.0), F.col("n")).alias("missing_pct"),
            )
            for i, name in enumerate(names)
        ],
    )
    if not keep_complete:
        long = long.filter(F.col("missing") > 0)
    return long.orderBy(F.desc("missing"), "column")


def rule_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break each rule, all rules counted in the same scan."""
    counts = [F.count_if(test).alias(f"r{i}") for i, test in enumerate(rules.values())]
    row = df.agg(F.count(F.lit(1)).alias("n"), *counts)
    return _one_row_to_long(
        row,
        [
            F.struct(
                F.lit(name).alias("rule"),
                F.col(f"r{i}").alias("violations"),
                F.col("n").alias("rows_checked"),
            )
            for i, name in enumerate(rules)
        ],
    )


def duplicate_groups(
    df: DataFrame, keys: Sequence[str] | None = None, condition: Column | None = None
) -> DataFrame:
    """Groups of equal rows (on ``keys``, else on all columns) with two or more members.

    Copies are counted before the shuffle, so a group that holds a third of the table
    sends one row per task.
    """
    names = list(keys or df.columns)
    source = df if condition is None else df.filter(condition)
    groups = source.groupBy(*names).agg(F.count(F.lit(1)).alias("copies"))
    return groups.filter(F.col("copies") > 1).orderBy(F.desc("copies"), *names)


def row_digest(columns: Sequence[str]) -> Column:
    """SHA-256 over all columns; a null differs from any value, and fields cannot run together."""
    texts = [F.col(c).cast("string") for c in columns]
    sized = [F.coalesce(F.concat(F.char_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat_ws("|", *sized), 256)


def full_row_duplicates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that occur more than once, each once, with ``copies``.

    Only 64-bit hashes are shuffled to find the rows that may be repeated, and those of more than one row
    are written, so that their number is known when rows are met with them. Different rows of one hash
    fall out as the rows themselves are counted. ``df`` is read twice.
    """
    names = list(columns or df.columns)
    # Spark has no hash of a map; the rows that differ in one alone are told apart by the count.
    hashed = [c for c, kind in df.select(*names).dtypes if "map<" not in kind]
    marked = df.select(*names, F.xxhash64(*hashed).alias("_hash") if hashed else F.lit(0).alias("_hash"))
    several = marked.groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > 1)
    met = marked.join(settled(several.select("_hash"), "repeated"), "_hash", "left_semi")
    # Grouped by the hash too: rows that were dealt by it need not be dealt again.
    groups = met.groupBy("_hash", *names).agg(F.count(F.lit(1)).alias("copies"))
    return groups.filter(F.col("copies") > 1).drop("_hash")


def full_row_summary(df: DataFrame) -> DataFrame:
    """Like :func:`duplicate_summary` over all columns, shuffling one digest per row."""
    return duplicate_summary(df.select(row_digest(df.columns).alias("_digest")), ["_digest"])


def duplicate_texts(df: DataFrame, text: str, row_id: str) -> DataFrame:
    """Groups of rows with the same long text, keyed by its SHA-256 digest.

    Only 32 bytes of digest per distinct text are shuffled, never the text.
    """
    return (
        df.groupBy(F.sha2(F.col(text), 256).alias("digest"))
        .agg(F.count(F.lit(1)).alias("copies"), F.min(row_id).alias(f"first_{row_id}"))
        .filter(F.col("copies") > 1)
    )


def duplicate_summary(df: DataFrame, keys: Sequence[str | Column] | None = None) -> DataFrame:
    """Row count, distinct count, and how many rows are surplus copies: one shuffle."""
    names = list(keys or df.columns)
    groups = df.groupBy(*names).agg(F.count(F.lit(1)).alias("copies"))
    return groups.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.count_if(F.col("copies") > 1).alias("repeated_groups"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("surplus_rows"),
    )


def numeric_summary(
    df: DataFrame, columns: Sequence[str], accuracy: int = 10_000, quartiles: bool = True
) -> DataFrame:
    """Count, mean, deviation, range and approximate quartiles per column, typed.

    Text columns get count and text range; their numeric measures are null. Without
    ``quartiles`` no sketch is built (see :func:`staylens.operators.quantiles.with_quartiles`
    for exact ones).
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    # One text range makes Spark aggregate all columns uncompiled, so numbers and text are read apart.
    parts = {True: ([], []), False: ([], [])}
    null_number, null_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    for i, name in enumerate(columns):
        column = F.col(name)
        numeric = isinstance(types[name], T.NumericType)
        aggregates, entries = parts[numeric]
        aggregates += [
            F.count(column).alias(f"n{i}"),
            F.min(column).alias(f"lo{i}"),
            F.max(column).alias(f"hi{i}"),
        ]
        if numeric:
            aggregates += [
                F.avg(column).alias(f"mean{i}"),
                F.stddev_samp(column).alias(f"sd{i}"),
            ]
            if quartiles:
                aggregates.append(F.percentile_approx(column.cast("double"), [0.25, 0.5, 0.75], accuracy).alias(f"q{i}"))

        def pick(expression: Column, empty: Column = null_number) -> Column:
            return expression if numeric else empty

        entries.append(
            F.struct(
                F.lit(i).alias("_place"),
                F.lit(name).alias("column"),
                F.col(f"n{i}").alias("count"),
                pick(F.col(f"mean{i}").cast("double")).alias("mean"),
                pick(F.col(f"sd{i}")).alias("stddev"),
                pick(F.col(f"lo{i}").cast("double")).alias("min"),
                *[
                    (pick(F.col(f"q{i}")[at]) if quartiles else null_number).alias(name_)
                    for at, name_ in enumerate(("p25", "p50", "p75"))
                ],
                pick(F.col(f"hi{i}").cast("double")).alias("max"),
                (null_text if numeric else F.col(f"lo{i}").cast("string")).alias("min_text"),
                (null_text if numeric else F.col(f"hi{i}").cast("string")).alias("max_text"),
            )
        )
    tables = [_one_row_to_long(df.agg(*aggregates), entries) for aggregates, entries in parts.values() if entries]
    return reduce(DataFrame.unionByName, tables).orderBy("_place").drop("_place")

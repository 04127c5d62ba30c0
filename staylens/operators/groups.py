"""Grouped measures, ranks, growth, shares and pivots.

Every window below runs on the rows of an aggregate (one row per group or period),
never on the input rows. Windows without a partition therefore see as many rows as
there are groups, which these questions keep small (years, months, segments, classes).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.functions import exact_sum, stable_round
from staylens.session import settled

_RANKS = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}


def _named(keys: Sequence[str] | Mapping[str, Column]) -> list[Column]:
    if isinstance(keys, Mapping):
        return [column.alias(name) for name, column in keys.items()]
    return [F.col(name) for name in keys]


def distribution(df: DataFrame, keys: Sequence[str] | Mapping[str, Column], count: str = "count") -> DataFrame:
    """Rows per group."""
    return df.groupBy(*_named(keys)).agg(F.count(F.lit(1)).alias(count))


def rate_measures(
    flag: Column, rate: str, volume: str | None = None, digits: int = 2, null_in_denominator: bool = False
) -> list[Column]:
    """Aggregates for "percent of rows with the 0/1 flag set".

    A null flag is left out of the base unless ``null_in_denominator``. Counts of flags are
    exact in any order, so plain rounding is repeatable here.
    """
    number = flag.cast("double")
    share = F.sum(number) / F.count(F.lit(1)) if null_in_denominator else F.avg(number)
    measures = [F.round(share * 100, digits).alias(rate)]
    if volume:
        measures.insert(0, F.count(F.lit(1)).alias(volume))
    return measures


def rate_by_group(
    df: DataFrame,
    keys: Sequence[str] | Mapping[str, Column],
    flag: Column,
    rate: str = "cancel_rate",
    volume: str | None = None,
    digits: int = 2,
    null_in_denominator: bool = False,
) -> DataFrame:
    return df.groupBy(*_named(keys)).agg(*rate_measures(flag, rate, volume, digits, null_in_denominator))


def rate_from_counts(
    df: DataFrame, keys: Sequence[str], total: str, flagged: str, rate: str, volume: str | None = None, digits: int = 2
) -> DataFrame:
    """Like :func:`rate_by_group`, from rows that already carry partial counts."""
    share = F.try_divide(F.sum(flagged).cast("double"), F.sum(total))
    measures = [F.round(share * 100, digits).alias(rate)]
    if volume:
        measures.insert(0, F.sum(total).alias(volume))
    return df.groupBy(*keys).agg(*measures)


def mean_by_group(
    df: DataFrame, keys: Sequence[str] | Mapping[str, Column], value: Column, name: str
) -> DataFrame:
    return df.groupBy(*_named(keys)).agg(F.avg(value).alias(name))


def rank_within(
    df: DataFrame,
    order: Sequence[Column],
    partition: Sequence[str] = (),
    method: str = "dense_rank",
    name: str = "rank",
) -> DataFrame:
    """Add a rank to aggregated rows."""
    window = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(name, _RANKS[method]().over(window).cast("bigint"))


def top_n_per_group(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[Column],
    n: int,
    method: str = "row_number",
    name: str = "rank",
) -> DataFrame:
    """Best ``n`` rows per group; ``rank`` and ``dense_rank`` keep ties.

    The rank filter sits right on the window, so each task cuts its groups down to the
    candidates before the shuffle and a huge group never meets in one task. Spark does so
    for ``n`` up to ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000); it is raised
    here where ``n`` is larger. With ``row_number`` the order must end in a unique column to
    be repeatable.
    """
    limit = "spark.sql.optimizer.windowGroupLimitThreshold"
    if n > int(df.sparkSession.conf.get(limit)):
        df.sparkSession.conf.set(limit, str(n))
    window = Window.partitionBy(*partition).orderBy(*order)
    ranked = df.withColumn(name, _RANKS[method]().over(window))
    kept = ranked.filter(F.col(name) <= n)
    return kept.withColumn(name, F.col(name).cast("bigint"))


def period_change(df: DataFrame, period: Sequence[str], value: str, digits: int = 2) -> DataFrame:
    """Previous period's value and the difference to it."""
    before = F.lag(value).over(Window.orderBy(*period))
    return df.withColumns(
        {"previous_year": before, "change_rate": stable_round(F.col(value) - before, digits)}
    )


def period_growth(
    df: DataFrame, period: Sequence[str], value: str, name: str, digits: int = 2
) -> DataFrame:
    """Growth in percent against the previous period; null after a period worth 0."""
    before = F.lag(value).over(Window.orderBy(*period))
    growth = F.try_divide(F.col(value) - before, before) * 100
    return df.withColumn(name, stable_round(growth, digits))


def revenue_by_period(
    df: DataFrame,
    period: Sequence[str] | Mapping[str, Column],
    amount: Column,
    realised: Column,
    scale: int = 2,
    digits: int = 2,
) -> DataFrame:
    """Potential, actual and lost revenue per period, and the lost share in percent.

    ``amount`` is in whole units of ``10**-scale`` (see :mod:`staylens.functions.money`).
    """
    totals = df.groupBy(*_named(period)).agg(
        exact_sum(amount, scale).alias("_all"),
        exact_sum(F.when(realised, amount).otherwise(F.lit(0).cast("bigint")), scale).alias("_kept"),
    )
    potential = F.round("_all", digits)
    actual = F.round("_kept", digits)
    return totals.select(
        *list(period),
        potential.cast("double").alias("revenue_potential"),
        actual.cast("double").alias("revenue_actual"),
        (potential - actual).cast("double").alias("revenue_lost"),
        stable_round(
            F.try_divide((potential - actual).cast("double"), potential.cast("double")) * 100, 2
        ).alias("lost_pct"),
    )


def amount_by_period(
    df: DataFrame,
    period: Sequence[str] | Mapping[str, Column],
    amount: Column,
    name: str = "revenue",
    scale: int = 2,
    digits: int = 0,
) -> DataFrame:
    """Rounded sum of whole units per period."""
    total = F.round(exact_sum(amount, scale), digits)
    return df.groupBy(*_named(period)).agg(total.cast("double").alias(name))


def share_of_total(
    df: DataFrame,
    keys: Sequence[str] | Mapping[str, Column],
    count: str = "booking_count",
    share: str = "percentage",
    within: Sequence[str] = (),
    digits: int = 2,
) -> DataFrame:
    """Group counts and their percentage of all rows, or of the rows of ``within``."""
    counted = distribution(df, keys, count)
    total = F.sum(count).over(Window.partitionBy(*within))
    return counted.withColumn(share, stable_round(F.col(count) * F.lit(100.0) / total, digits))


def pivot_matrix(
    df: DataFrame, row: Sequence[str], column: str, value: str, values: Sequence = (), prefix: str = "",
    unknown: str = "unknown",
) -> DataFrame:
    """One column per value of ``column``; combinations that do not occur are 0.

    ``values`` come first and are always there; values found besides them follow in order,
    and a null gets the column ``unknown``. ``df`` holds aggregated rows; they are written
    once, as finding the values and filling the cells both read them.
    """
    rows = settled(df, "pivot")
    found = {r[0] for r in rows.select(column).distinct().collect()}  # they become columns, so they are few
    names = list(values) + sorted(v for v in found - set(values) if v is not None)
    zero = F.lit(0).cast(dict(df.dtypes)[value])

    def cell(test: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col(value))), zero).alias(f"{prefix}{name}")

    cells = [cell(F.col(column) == v, v) for v in names]
    if None in found:
        cells.append(cell(F.col(column).isNull(), unknown))
    return rows.groupBy(*row).agg(*cells)


def flag_label_rate(
    df: DataFrame, is_marked: Column, marked: str, other: str, flag: Column, label: str = "guest_type"
) -> DataFrame:
    """Volume and rate for two labels; rows where the mark is null count as ``other``."""
    text = F.when(is_marked, marked).otherwise(other)
    return rate_by_group(df, {label: text}, flag, volume="total_booking")


def peak_per_period(
    df: DataFrame, period: str, item: Sequence[str], value: str, also: Sequence[Column] = ()
) -> DataFrame:
    """The row with the largest value per period; the earliest item (a number) wins a tie.

    ``also`` are further aggregates over the period's rows.
    """
    best = F.max_by(F.struct(value, *item), F.struct(F.col(value), *[-F.col(i) for i in item]))
    table = df.groupBy(period).agg(best.alias("_best"), *also)
    return table.select(period, "_best.*", *[c for c in table.columns if c not in (period, "_best")])

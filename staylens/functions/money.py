"""Exact sums of amounts that have a fixed number of decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LOW_BITS = 20


def _scaled(number: Column, scale: int) -> tuple[Column, Column]:
    """Whole units, and whether the number is no amount."""
    bad = F.isnan(number) | (F.abs(number) >= F.lit(float(1 << 62) / 10**scale))
    return F.floor(number * F.lit(float(10**scale)) + 0.5), bad


def units(amount: Column, scale: int = 2) -> Column:
    """Amount as a whole number of smallest units (cents for ``scale`` 2).

    Choose a scale finer than the amounts' digits and round the sum, not the rows. NaN,
    infinities and amounts beyond a long are refused: none of them may count as 0.
    """
    number = amount.cast("double")
    scaled, bad = _scaled(number, scale)
    refused = F.raise_error(F.concat(F.lit("not an amount: "), number.cast("string"))).cast("bigint")
    return F.when(bad, refused).otherwise(scaled)


def units_or_null(amount: Column, scale: int = 2) -> Column:
    """Like :func:`units` for streams, where one bad message must not stop the query: what is no amount is null."""
    number = amount.cast("double")
    scaled, bad = _scaled(number, scale)
    return F.when(~bad, scaled)


def exact_sum(whole: Column, scale: int = 2) -> Column:
    """Sum of whole units as a decimal with ``scale`` places.

    Summing decimals row by row costs several times a long addition, and a sum of
    doubles changes with the order of its parts. So the units are summed as longs, in
    two parts, whose totals stay far from overflow for any table; the decimal is built
    once per group.
    """
    high = F.sum(F.shiftright(whole, _LOW_BITS)).cast("decimal(30,0)")
    low = F.sum(whole.bitwiseAND(F.lit((1 << _LOW_BITS) - 1).cast("bigint"))).cast("decimal(30,0)")
    total = (high * F.lit(1 << _LOW_BITS).cast("decimal(7,0)") + low).cast("decimal(38,0)")
    return (total * F.lit(10.0**-scale).cast(f"decimal({scale + 1},{scale})")).cast(f"decimal(38,{scale})")

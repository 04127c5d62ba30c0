"""Rounding that does not depend on the order in which partial sums were merged."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wider than the noise of summing doubles, which grows with the size of the result.
_TIE_NOISE = 1e-9
_RELATIVE_NOISE = 1e-12
# Large values are not moved by more than this part of their last digit.
_MOST_NOISE = 1e-3
# From here on doubles are whole numbers.
_NO_FRACTION = float(1 << 52)


def stable_round(value: Column, digits: int = 2) -> Column:
    """Round half away from zero, as a double, for means and rates.

    The mean of two-decimal values often falls exactly on a tie, where the last bit
    of the sum (it varies with partitioning and retries) would decide. Sums of money
    are exact instead (see :mod:`staylens.functions.money`). NaN, infinities and values too
    large to have such digits stay as they are.
    """
    scale = float(10**digits)
    number = value.cast("double")
    scaled = F.abs(number) * scale
    noise = F.least(scaled * _RELATIVE_NOISE, F.lit(_MOST_NOISE)) + _TIE_NOISE
    size = F.floor(scaled + noise + 0.5)
    rounded = F.when(number < 0, -size).otherwise(size) / F.lit(scale)
    return F.when(F.isnan(number) | (scaled >= _NO_FRACTION), number).otherwise(rounded)

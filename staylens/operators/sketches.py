"""Stored sketches per period that merge to any span without reading its rows again.

Ranks come from KLL sketches, distinct counts from HLL sketches. Both merge in any order to the
same bounds: a KLL sketch of ``RANK_SIZE`` has a rank error below 0.5 % with 99 % confidence, an HLL
sketch of ``2**DISTINCT_BITS`` registers a standard error of 0.8 %. Their size does not grow
with the rows. Nulls and NaN are left out; a period without values has an empty sketch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANK_SIZE, DISTINCT_BITS = 800, 14


def period_sketches(
    df: DataFrame, period: Mapping[str, Column], ranked: Mapping[str, Column] | None = None, distinct: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row per period with a binary sketch per name of ``ranked`` (numbers) and ``distinct`` (any values)."""
    measures = []
    for name, value in (ranked or {}).items():
        number = value.cast("double")
        measures.append(F.kll_sketch_agg_double(F.when(~F.isnan(number), number), F.lit(RANK_SIZE)).alias(name))
    for name, value in (distinct or {}).items():
        measures.append(F.hll_sketch_agg(value.cast("string"), F.lit(DISTINCT_BITS)).alias(name))
    return df.groupBy(*[c.alias(n) for n, c in period.items()]).agg(*measures)


def merged(
    sketches: DataFrame, span: Mapping[str, Column], ranked: Sequence[str] = (), distinct: Sequence[str] = ()
) -> DataFrame:
    """Sketches of longer spans from stored ones."""
    measures = [F.kll_merge_agg_double(n, F.lit(RANK_SIZE)).alias(n) for n in ranked]
    measures += [F.hll_union_agg(n).alias(n) for n in distinct]
    return sketches.groupBy(*[c.alias(n) for n, c in span.items()]).agg(*measures)


def quantiles(sketch: str, probabilities: Sequence[float]) -> Column:
    """Array of approximate quantiles."""
    return F.array(*[F.kll_sketch_get_quantile_double(sketch, F.lit(float(p))) for p in probabilities])


def values_seen(sketch: str) -> Column:
    """Number of values in a rank sketch, which is exact."""
    return F.kll_sketch_get_n_double(sketch)


def distinct_estimate(sketch: str) -> Column:
    return F.hll_sketch_estimate(sketch)

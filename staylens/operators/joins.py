"""Set difference by key."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``.

    Null keys equal each other, as in a set. The right side is reduced to distinct keys
    first: a key held by a third of its rows then shuffles as one row per task.
    """
    others = right.select(*[F.col(k).alias(f"_right_{i}") for i, k in enumerate(keys)]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_right_{i}")) for i, k in enumerate(keys)]
    return left.join(others, reduce(lambda a, b: a & b, same), "left_anti")

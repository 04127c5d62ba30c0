"""Alert levels of a percentage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bounds (inclusive, percent), highest first, and the level below all.
ALERT_LEVELS = ((60.0, "CRITICAL"), (50.0, "WARNING"), (37.0, "ELEVATED"))
NORMAL = "NORMAL"


def alert_level(rate: Column, levels=ALERT_LEVELS, otherwise: str = NORMAL) -> Column:
    """First level whose bound ``rate`` reaches."""
    ordered = sorted(levels, reverse=True)
    label = F.when(rate >= ordered[0][0], ordered[0][1])
    for bound, name in ordered[1:]:
        label = label.when(rate >= bound, name)
    return label.otherwise(otherwise)

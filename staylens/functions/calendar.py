"""Month names, month numbers and seasons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Months of each season; any other month is autumn.
SEASON_MONTHS = {
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
}
LAST_SEASON = "Autumn"


def month_number(name: Column) -> Column:
    """``'July'`` -> ``7``; null for text that is no English month name."""
    return F.month(F.try_to_date(name, "MMMM"))


def month_text(name: Column) -> Column:
    """``'July'`` -> ``'07'``, which sorts like the calendar."""
    return F.date_format(F.try_to_date(name, "MMMM"), "MM")


def season_of_month(number: Column) -> Column:
    """Season label of a month number; unknown months count as the last season."""
    label = None
    for season, months in SEASON_MONTHS.items():
        test = number.isin(*months)
        label = F.when(test, season) if label is None else label.when(test, season)
    return label.otherwise(LAST_SEASON)

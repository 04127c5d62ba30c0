"""Column expressions: everything here stays inside generated JVM code."""

from staylens.functions.calendar import month_number, month_text, season_of_month
from staylens.functions.missing import MISSING_TOKENS, fill_missing, is_missing
from staylens.functions.money import exact_sum, units, units_or_null
from staylens.functions.rounding import stable_round
from staylens.functions.alerts import ALERT_LEVELS, alert_level

__all__ = [
    "ALERT_LEVELS", "MISSING_TOKENS", "alert_level", "exact_sum", "fill_missing", "is_missing",
    "month_number", "month_text", "season_of_month", "stable_round", "units", "units_or_null",
]

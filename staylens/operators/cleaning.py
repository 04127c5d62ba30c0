"""Rule-based cleaning. All steps are narrow: no shuffle, no action."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions import MISSING_TOKENS, fill_missing

# Replacement for a missing country and a missing agent.
SENTINELS = {"country": "Unknown", "agent": "9999"}
# Upper limits; the rate is exclusive, the head counts inclusive.
RATE_BELOW = {"adr": 5000.0}
AT_MOST = {"adults": 4, "children": 3, "babies": 3}


def _guests() -> Column:
    return F.col("adults") + F.col("children") + F.col("babies")


def _nights() -> Column:
    return F.col("stays_in_weekend_nights") + F.col("stays_in_week_nights")


def logic_rules() -> dict[str, Column]:
    """The seven contradictions looked for in a reservation row, in report order."""
    canceled, status = F.col("is_canceled"), F.col("reservation_status")
    return {
        "no_guests": _guests() == 0,
        "no_nights_and_free": (_nights() == 0) & (F.col("adr") == 0),
        "waiting_beyond_lead_time": F.col("days_in_waiting_list") > F.col("lead_time"),
        "negative_rate": F.col("adr") < 0,
        "status_contradicts_flag": ((canceled == 1) & (status == "Check-Out"))
        | ((canceled == 0) & status.isin("Canceled", "No-Show")),
        "minors_alone": (F.col("adults") == 0) & ((F.col("children") > 0) | (F.col("babies") > 0)),
        "repeated_without_history": repeated_without_history(),
    }


# Rules whose rows are removed; the others are only reported or corrected.
REMOVED_RULES = ("no_guests", "no_nights_and_free", "negative_rate", "minors_alone")


def repeated_without_history() -> Column:
    return (
        (F.col("is_repeated_guest") == 1)
        & (F.col("previous_cancellations") == 0)
        & (F.col("previous_bookings_not_canceled") == 0)
    )


def fix_types(df: DataFrame) -> DataFrame:
    """``children`` as a number: missing counts as none.

    Other text that is no number becomes null, and a null guest count removes the row later;
    :func:`clean_counts` reports how many rows that are.
    """
    if dict(df.dtypes)["children"] != "string":
        return df.withColumn("children", F.coalesce(F.col("children").cast("int"), F.lit(0)))
    text = F.col("children")
    missing = text.isNull() | text.isin(*MISSING_TOKENS)
    # Through double: files written by other tools may hold "1.0".
    number = text.try_cast("double").try_cast("int")
    return df.withColumn("children", F.when(missing, F.lit(0)).otherwise(number))


def correct_flags(df: DataFrame) -> DataFrame:
    """A repeated guest without any past booking is a new guest."""
    return df.withColumn(
        "is_repeated_guest",
        F.when(repeated_without_history(), F.lit(0)).otherwise(F.col("is_repeated_guest")),
    )


def passes_rules() -> Column:
    """True where every removing rule is known to be false.

    A rule that cannot be decided because a value is null counts against the row, and so
    does a guest count or rate that is null.
    """
    rules = logic_rules()
    keep = (_guests() > 0) & (F.col("adr") >= 0)
    for name in REMOVED_RULES:
        keep = keep & ~rules[name]
    return keep


def within_caps(below: Mapping[str, float] = RATE_BELOW, at_most: Mapping[str, float] = AT_MOST) -> Column:
    keep = F.lit(True)
    for name, bound in below.items():
        keep = keep & (F.col(name) < bound)
    for name, bound in at_most.items():
        keep = keep & (F.col(name) <= bound)
    return keep


def remove_violations(df: DataFrame) -> DataFrame:
    return df.filter(passes_rules())


def impute(df: DataFrame, sentinels: Mapping[str, str] = SENTINELS) -> DataFrame:
    """Put a sentinel where a text column, if the table has it, is null or holds a token."""
    present = {name: value for name, value in sentinels.items() if name in df.columns}
    return df.withColumns({name: fill_missing(name, value) for name, value in present.items()})


def cap_outliers(
    df: DataFrame,
    below: Mapping[str, float] = RATE_BELOW,
    at_most: Mapping[str, float] = AT_MOST,
) -> DataFrame:
    """Drop rows with extreme values (that is the step's purpose; nulls go as well)."""
    return df.filter(within_caps(below, at_most))


def clean(df: DataFrame) -> DataFrame:
    """The whole chain; exact copies of rows are kept on purpose."""
    checked = remove_violations(correct_flags(fix_types(df)))
    return cap_outliers(impute(checked.drop("company")))


def unreadable_children(df: DataFrame) -> Column:
    """True for text that is neither missing nor a number."""
    if dict(df.dtypes)["children"] != "string":
        return F.lit(False)
    text = F.col("children")
    return text.isNotNull() & ~text.isin(*MISSING_TOKENS) & text.try_cast("double").try_cast("int").isNull()


def clean_counts(df: DataFrame) -> DataFrame:
    """Rows at the start, with an unreadable guest count, after the rules and after the caps: one scan."""
    marked = df.withColumn("_unreadable", unreadable_children(df))
    return fix_types(marked).agg(
        F.count(F.lit(1)).alias("rows_raw"),
        F.count_if("_unreadable").alias("rows_unreadable"),
        F.count_if(passes_rules()).alias("rows_after_rules"),
        F.count_if(passes_rules() & within_caps()).alias("rows_after_caps"),
    )

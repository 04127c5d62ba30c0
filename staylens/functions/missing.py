"""The three kinds of "missing": SQL null, a text token, and NaN in floating columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that stands for "no value" in the source files.
MISSING_TOKENS = ("NULL", "NA")


def is_missing(name: str, dtype: str, tokens: Iterable[str] = MISSING_TOKENS) -> Column:
    """True where column ``name`` of Spark type ``dtype`` holds no value.

    The column is compared as text: under ANSI rules an integer column compared
    with ``'NULL'`` would raise. A type that cannot hold a token skips that test,
    so that a numeric scan stays numeric.
    """
    column = F.col(name)
    if dtype in ("double", "float"):
        return column.isNull() | F.isnan(column)
    if dtype in ("string",) or dtype.startswith(("varchar", "char")):
        return column.isNull() | column.isin(*tokens)
    return column.isNull()


def fill_missing(name: str, sentinel: str, tokens: Iterable[str] = MISSING_TOKENS) -> Column:
    """``name`` as text, with ``sentinel`` in place of nulls and tokens."""
    text = F.col(name).cast("string")
    return F.when(text.isNull() | text.isin(*tokens), F.lit(sentinel)).otherwise(text)

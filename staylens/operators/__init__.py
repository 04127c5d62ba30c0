"""Operators: DataFrames and column names in, a DataFrame out, no action run
(only the exact quantiles need a few bounded passes of their own)."""

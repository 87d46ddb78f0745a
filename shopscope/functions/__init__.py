"""Scalar column functions (strip, title case, lenient parsing, rounding)."""

from shopscope.functions.scalar import (  # noqa: F401
    day_start, even_round, false_if_null, lenient_number, lenient_timestamp, mean,
    month_start, percent, sql_round, strip, title_case, whole_days, zero_fill,
)

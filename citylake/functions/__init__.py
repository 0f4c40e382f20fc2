"""Column expressions. Everything here stays inside Catalyst; there are no Python UDFs."""

from citylake.functions.scalars import (
    array_at,
    as_date,
    avg_or_zero,
    cast_to,
    duration_minutes,
    exact_avg,
    exact_sum,
    first_element,
    first_of,
    is_weekend,
    nan_to_null,
    pad2,
    percent_text,
    rate,
    slot_path_text,
)

__all__ = [
    "array_at",
    "as_date",
    "avg_or_zero",
    "cast_to",
    "duration_minutes",
    "exact_avg",
    "exact_sum",
    "first_element",
    "first_of",
    "is_weekend",
    "nan_to_null",
    "pad2",
    "percent_text",
    "rate",
    "slot_path_text",
]

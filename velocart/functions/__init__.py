"""Column-level helpers, all built from JVM-side Spark SQL functions."""

from velocart.functions.scalar import (
    age_years,
    as_column,
    calendar_year,
    cast_strict,
    holds,
    line_amount,
    to_date_strict,
)

__all__ = [
    "age_years",
    "as_column",
    "calendar_year",
    "cast_strict",
    "holds",
    "line_amount",
    "to_date_strict",
]

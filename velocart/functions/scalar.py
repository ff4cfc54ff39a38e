"""Scalar column functions with the source dialect's semantics.

Every helper returns a ``Column`` made of built-in expressions, so it stays
inside whole-stage code generation; none needs a Python worker.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value) -> Column:
    """Column name, Column or Python literal (dates become DATE literals)."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.col(value)
    return F.lit(value)


def _date_literal(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = _dt.date.fromisoformat(value)
    return F.lit(value)


def holds(col) -> Column:
    """``x IS TRUE`` as a filter condition (or a conjunct of one).

    A WHERE clause keeps a row only when its condition is true, so NULL and
    false are dropped alike and ``x IS TRUE`` filters exactly like ``x``.
    Returning ``x`` itself lets Spark push the underlying comparison (for
    example an ``IN`` list on the source column) into the Parquet scan,
    which ``x <=> true`` would block.
    """
    return as_column(col)


def cast_strict(col, data_type) -> Column:
    """Cast; a value that does not fit raises an error, in any session (ANSI mode or not)."""
    value = as_column(col)
    cast = value.try_cast(data_type)
    message = F.concat(F.lit("value does not fit its type: "), value.cast("string"))
    return F.when(value.isNotNull() & cast.isNull(), F.raise_error(message).cast(data_type)).otherwise(cast)


def to_date_strict(col) -> Column:
    """``text::date``: malformed text raises an error, in any session."""
    return cast_strict(col, "date")


def age_years(birth, as_of) -> Column:
    """Completed years between ``birth`` and ``as_of``.

    Same as ``extract(year from age(as_of, birth))``: a birthday on 29 Feb
    is complete on 1 Mar of a non-leap year, not on 28 Feb. ``as_of`` is a
    date, an ISO string or a Column; pass a fixed date so runs repeat.
    """
    return F.timestamp_diff("YEAR", to_date_strict(birth), _date_literal(as_of))


def calendar_year(col) -> Column:
    """``extract(year from d)``."""
    return F.year(as_column(col))


def line_amount(price, quantity) -> Column:
    """``price * quantity`` in exact decimal arithmetic."""
    return as_column(price) * as_column(quantity)


def date_value(value) -> Column:
    """A date literal from an ISO string or ``datetime.date``."""
    return _date_literal(value)

"""Projection, filter and join operators in the source dialect's semantics.

Join strategy is left to the planner: file-size estimates and adaptive
execution's measured sizes decide what is broadcast, otherwise a sort-merge
join is planned and skewed partitions are split. Building a plan starts no
job. Explicit broadcasts are ``broadcast_limited``, of rows that a LIMIT keeps
few, and ``broadcast_declared``, of rows that are held to a declared bound.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velocart.functions.scalar import as_column, date_value, holds

# Most rows that are broadcast by a hint; their number must be bounded by
# construction (a LIMIT k), or declared by the caller and held to it.
LIMITED_ROWS = 10_000


def broadcast_limited(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast of ``df`` if a LIMIT keeps it to ``max_rows`` rows and that is few."""
    return F.broadcast(df) if max_rows <= LIMITED_ROWS else df


def broadcast_declared(df: DataFrame, max_rows: int | None, what: str = "rows") -> DataFrame:
    """Hint a broadcast of ``df`` if the caller declares that it has at most ``max_rows`` rows and that is few.

    The declaration is held to when the query runs: at most ``max_rows`` + 1
    rows are gathered, and if there is one too many the query fails and says
    so. A wrong number can neither broadcast a large table nor change a result.
    """
    if max_rows is None or max_rows > LIMITED_ROWS:
        return df
    gathered = df.limit(max_rows + 1).agg(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("__rows"))
    too_many = F.raise_error(F.lit(f"more than the declared {max_rows} {what}"))
    kept = F.when(F.size("__rows") <= max_rows, F.col("__rows")).otherwise(too_many.cast(gathered.schema["__rows"].dataType))
    return F.broadcast(gathered.select(F.inline(kept)))


def latest_year(df: DataFrame, col) -> Column:
    """``year(col) = year of the latest col of df``, as a filter condition.

    The year comes from a one-row scalar sub-query, evaluated once; the
    condition is a date range, so it skips row groups and whole folders of a
    table stored by date, which ``year(col) = y`` would all read.
    """
    c = as_column(col)
    year = df.agg(F.year(F.max(c)).alias("y")).scalar()
    first = F.make_date(year, F.lit(1), F.lit(1))
    return (c >= first) & (c < F.make_date(year + 1, F.lit(1), F.lit(1)))


def bucketed_alike(left: DataFrame, right: DataFrame, key: str) -> bool:
    """Whether both frames are read hash-partitioned by ``key`` into equally many parts (tables stored bucketed by it),
    so that a join by ``key`` moves neither. Planning only, no job."""

    def parts(df: DataFrame) -> str | None:
        dealt = df.select(key)._jdf.queryExecution().sparkPlan().outputPartitioning().toString()
        found = re.fullmatch(rf"hashpartitioning\({re.escape(key)}#\d+L?, (\d+)\)", dealt)
        return found.group(1) if found else None

    return parts(left) is not None and parts(left) == parts(right)


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``select c1, c2, ...``."""
    return df.select(*columns)


def project_rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """``select a as x, b as y``: keeps only the mapped columns, in order."""
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])


def distinct_values(df: DataFrame, columns: Sequence[str] | str) -> DataFrame:
    """``select distinct ...`` (a NULL value is kept as one row)."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    return df.select(*cols).distinct()


def filter_eq(df: DataFrame, col, value) -> DataFrame:
    return df.filter(as_column(col) == F.lit(value))


def filter_ne(df: DataFrame, col, value) -> DataFrame:
    """``col <> v``: a NULL ``col`` drops the row."""
    return df.filter(as_column(col) != F.lit(value))


def filter_gt(df: DataFrame, col, value) -> DataFrame:
    return df.filter(as_column(col) > F.lit(value))


def date_range(col, start, end, closed_end: bool = True) -> Column:
    """``start <= col <= end`` (closed) or ``start <= col < end`` (half-open)."""
    c = as_column(col)
    upper = c <= date_value(end) if closed_end else c < date_value(end)
    return (c >= date_value(start)) & upper


def filter_date_range(df: DataFrame, col, start, end, closed_end: bool = True) -> DataFrame:
    return df.filter(date_range(col, start, end, closed_end))


def filter_is_true(df: DataFrame, col) -> DataFrame:
    """``col is true``: NULL and false both drop the row."""
    return df.filter(holds(col))


def filter_in(df: DataFrame, col, values) -> DataFrame:
    return df.filter(as_column(col).isin(list(values)))


def filter_ilike(df: DataFrame, col, pattern: str) -> DataFrame:
    return df.filter(as_column(col).ilike(pattern))


def left_join_using(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left join r using (k)``: one merged key column, left rows always kept."""
    return left.join(right, key, "left")


def semi_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``where k in (select k from r)``: left rows with a match, each once."""
    return left.join(right.select(key), key, "left_semi")


def anti_join(left: DataFrame, right: DataFrame, key: str, null_matches: bool = False) -> DataFrame:
    """Left rows without a partner on ``key``.

    ``null_matches=False`` is ``not exists (... where r.k = l.k)``: a NULL key
    on the left survives. ``True`` is the EXCEPT flavour: NULL equals NULL.
    (``not in`` is neither and is not offered.)
    """
    r = right.select(F.col(key).alias("__anti_key"))
    cond = F.col(key).eqNullSafe(F.col("__anti_key")) if null_matches else F.col(key) == F.col("__anti_key")
    return left.join(r, cond, "left_anti")

"""Grouped aggregates and group-relative filters.

All aggregates here are decomposable (count, sum, max, bool_or, and exact
count-distinct via Spark's two-level expansion), so partial results are
combined on the map side before any shuffle: a key that holds a third of all
rows sends one partial row per map task, not a third of the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velocart.functions.scalar import as_column
from velocart.operators.relational import broadcast_declared


def _cols(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def count_rows(df: DataFrame, keys, name: str = "row_count") -> DataFrame:
    """``select k, count(*) ... group by k``."""
    return df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias(name))


def count_distinct(df: DataFrame, keys, col, name: str) -> DataFrame:
    """``count(distinct c)`` per key; exact, NULLs skipped."""
    return df.groupBy(*_cols(keys)).agg(F.count_distinct(as_column(col)).alias(name))


def sum_by(df: DataFrame, keys, col, name: str) -> DataFrame:
    """``sum(c)`` per key; NULL when every value is NULL."""
    return df.groupBy(*_cols(keys)).agg(F.sum(as_column(col)).alias(name))


def max_global(df: DataFrame, col, name: str) -> DataFrame:
    """``select max(c) from t``: one row, even on an empty input."""
    return df.agg(F.max(as_column(col)).alias(name))


def having(df: DataFrame, condition: Column) -> DataFrame:
    """Filter on aggregate aliases (the HAVING clause)."""
    return df.filter(condition)


def _group_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    return df.groupBy(F.col(group).alias("__g")).agg(
        F.sum(value).alias("__sum"), F.count(value).alias("__n")
    )


def with_group_mean(df: DataFrame, group: str, value: str, name: str = "group_mean", max_groups: int | None = None) -> DataFrame:
    """Add ``avg(value) over (partition by group)`` as a double.

    The mean is ``double(sum) / count`` of the non-NULL values (NULL when a
    group has none). Per-group sums are computed with map-side partial
    aggregation and joined back, so no task ever holds a whole group; NULL
    group keys form one group. ``max_groups`` declares a bound on the number
    of groups, for a broadcast; with more groups the query fails. Without it
    the planner decides.
    """
    stats = broadcast_declared(_group_stats(df, group, value), max_groups, f"groups of {group}")
    mean = F.when(F.col("__n") > 0, F.col("__sum").cast("double") / F.col("__n"))
    joined = df.join(stats, F.col(group).eqNullSafe(F.col("__g")), "inner")
    return joined.withColumn(name, mean).drop("__g", "__sum", "__n")


def above_group_mean(df: DataFrame, group: str, value: str, max_groups: int | None = None) -> DataFrame:
    """Rows whose ``value`` is strictly above the mean of their ``group``.

    Compared without division, ``value * count > sum``, which is exact for
    integer and decimal values (a rounded decimal mean can flip a row that
    sits on the mean). The mean covers every row of the group; filter other
    conditions after calling this, not before. Rows with a NULL value drop.
    ``max_groups``: see ``with_group_mean``.
    """
    stats = broadcast_declared(_group_stats(df, group, value), max_groups, f"groups of {group}")
    # a semi join with the comparison in its condition: keeps df's columns
    # and lets the planner size the result as df, not df x stats
    cond = F.col(group).eqNullSafe(F.col("__g")) & (F.col(value) * F.col("__n") > F.col("__sum"))
    return df.join(stats, cond, "left_semi")

"""Ordering and top-k with the source dialect's NULL placement.

The source database sorts NULL as the largest value: last ascending, first
descending. Spark's defaults are the opposite, so every order spells it out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def asc(col) -> Column:
    return (F.col(col) if isinstance(col, str) else col).asc_nulls_last()


def desc(col) -> Column:
    return (F.col(col) if isinstance(col, str) else col).desc_nulls_first()


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """``order by ... limit k``.

    Planned as a per-task top-k followed by a merge of at most
    ``k * tasks`` rows, never a full sort. Add the key as the last sort
    column so ties break the same way on every run.
    """
    return df.orderBy(*order).limit(k)

"""Set operations with SQL semantics (by column name)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(*frames: DataFrame) -> DataFrame:
    """``a union all b``: bag union, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    """``a union b``: distinct rows of both inputs."""
    return union_all(*frames).distinct()


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """``a except b``: distinct rows of ``a`` absent from ``b``; NULL equals NULL."""
    return left.select(*left.columns).subtract(right.select(*left.columns))

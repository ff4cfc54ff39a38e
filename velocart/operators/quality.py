"""Key audits and deterministic deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velocart.functions.scalar import as_column

FILE_ORDER = "file_order"


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def duplicate_keys(df: DataFrame, keys, count_name: str = "row_count") -> DataFrame:
    """Keys that occur more than once, with their row count, sorted by key.

    ``group by k having count(*) > 1 order by k``. A NULL key is one group
    and sorts last (the source dialect's ascending order). Partial counts are
    taken before the shuffle, so a key holding a large share of the rows
    still moves one row per map task.
    """
    ks = _keys(keys)
    return (
        df.groupBy(*ks)
        .agg(F.count(F.lit(1)).alias(count_name))
        .filter(F.col(count_name) > 1)
        .orderBy(*[F.col(k).asc_nulls_last() for k in ks])
    )


def _natural(name: Column) -> Column:
    """A sort key that orders numbers inside names by value: part-2 before part-10."""
    pieces = F.regexp_extract_all(name, F.lit("([0-9]+|[^0-9]+)"), 1)
    return F.array_join(F.transform(pieces, lambda x: F.when(x.rlike("^[0-9]"), F.lpad(x, 24, "0")).otherwise(x)), "")


def _is_direct_scan(df: DataFrame) -> bool:
    """Whether ``df`` is files read as they are, but for projections and filters."""
    plan = df._jdf.queryExecution().analyzed().toString()
    nodes = {line.lstrip(" :+-").split(" ")[0] for line in plan.splitlines() if line.strip()}
    return nodes <= {"Project", "Filter", "Relation", "SubqueryAlias"}


#: Columns that ``with_file_order`` adds; ascending, they are the order of import.
FILE_ORDER_COLUMNS = ("__src_time", "__src_file", "__src_block", "__src_row")


def with_file_order(df: DataFrame) -> DataFrame:
    """Add the position of each row as imported: the file's modification time, its name with numbers by value, and the
    row's place in the file.

    Only on a direct scan of files. A Parquet row has a place of its own
    (``row_index``). Rows of a text format (CSV, JSON lines) have the first
    byte of the split they are read with, and are numbered as the task reads
    them, so within a split in the order of the file; splits of a file follow
    each other by their first bytes. So rows come in the order of the files
    however those are split, without a count of the rows before them, and a
    repeated task numbers its splits' rows alike. Other frames need an import
    sequence column of their own.
    """
    file = {"__src_time": F.col("_metadata.file_modification_time"), "__src_file": _natural(F.col("_metadata.file_path"))}
    by_row = {"__src_block": F.lit(0).cast("long"), "__src_row": F.col("_metadata.row_index")}
    by_split = {"__src_block": F.col("_metadata.file_block_start"), "__src_row": F.monotonically_increasing_id()}
    error = None
    for place in (by_row, by_split) if _is_direct_scan(df) else ():
        try:
            return df.withColumns({**file, **place})
        except AnalysisException as e:
            error = e
    raise ValueError("file order needs a direct scan of files; give keep_first an import sequence column") from error


def keep_first(
    df: DataFrame,
    keys,
    order_by: Sequence[str | Column] | str,
    rank_name: str = "__keep_first_rank",
) -> DataFrame:
    """One row per key: the first by ``order_by``; all original columns kept.

    ``row_number() over (partition by keys order by ...) = 1``. The order must
    be total within a key: a recomputed task (lost executor) then picks the
    same row. ``order_by=FILE_ORDER`` uses the file position of a direct scan
    of Parquet, CSV or JSON files. Spark plans the ``rn = 1`` filter as a per-task group limit before
    the shuffle, so each map task sends at most one row per key, however
    skewed the key is.
    """
    ks = _keys(keys)
    base = df
    if isinstance(order_by, str) and order_by == FILE_ORDER:
        base = with_file_order(df)
        order_cols = [F.col(c).asc() for c in FILE_ORDER_COLUMNS]
    else:
        if isinstance(order_by, (str, Column)):
            order_by = [order_by]
        order_cols = [as_column(c) for c in order_by]
        if not order_cols:
            raise ValueError("keep_first needs an order that is total within each key")
    w = Window.partitionBy(*ks).orderBy(*order_cols)
    ranked = base.withColumn(rank_name, F.row_number().over(w))
    return ranked.filter(F.col(rank_name) == 1).select(*df.columns)

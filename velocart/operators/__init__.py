"""Reusable DataFrame operators."""

from velocart.operators.aggregates import (
    above_group_mean,
    count_distinct,
    count_rows,
    having,
    max_global,
    sum_by,
    with_group_mean,
)
from velocart.operators.quality import FILE_ORDER, duplicate_keys, keep_first, with_file_order
from velocart.operators.relational import (
    anti_join,
    broadcast_declared,
    broadcast_limited,
    bucketed_alike,
    date_range,
    distinct_values,
    filter_date_range,
    filter_eq,
    filter_gt,
    filter_ilike,
    filter_in,
    filter_is_true,
    filter_ne,
    latest_year,
    left_join_using,
    project,
    project_rename,
    semi_join,
)
from velocart.operators.setops import except_distinct, union_all, union_distinct
from velocart.operators.topk import asc, desc, top_k

__all__ = [name for name in dir() if not name.startswith("_")]

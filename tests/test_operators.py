"""Set operations and joins on rows with NULLs, and the JSON typed load."""

import pytest
from conftest import rows
from pyspark.sql import types as T

from velocart.operators import (
    anti_join,
    distinct_values,
    except_distinct,
    semi_join,
    union_all,
    union_distinct,
    with_group_mean,
)
from velocart.sources import load_typed


def test_anti_join_null_handling(spark):
    left = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    right = spark.createDataFrame([("a",), (None,)], "k string")
    # NOT EXISTS (=): NULL never matches, so the NULL row stays
    assert rows(anti_join(left, right, "k")) == [(None,), ("b",)]
    # EXCEPT (NULL = NULL): the NULL row is removed
    assert rows(anti_join(left, right, "k", null_matches=True)) == [("b",)]
    assert rows(except_distinct(left, right)) == [("b",)]


def test_union_all_vs_union(spark):
    a = spark.createDataFrame([("x",), (None,)], "v string")
    b = spark.createDataFrame([("x",), (None,), ("y",)], "v string")
    assert rows(union_all(a, b)) == [(None,), (None,), ("x",), ("x",), ("y",)]
    assert rows(union_distinct(a, b)) == [(None,), ("x",), ("y",)]
    assert rows(distinct_values(union_all(a, b), "v")) == [(None,), ("x",), ("y",)]


def test_semi_join_keeps_each_left_row_once(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, v string")
    right = spark.createDataFrame([(1,), (1,), (None,)], "k long")
    assert rows(semi_join(left, right, "k")) == [(1, "a")]


def test_group_mean_with_null_group_and_all_null_values(spark):
    df = spark.createDataFrame(
        [(1, "g", 2), (2, "g", 4), (3, None, 10), (4, None, None), (5, "h", None)], "id int, grp string, v int"
    )
    got = {r.id: r.group_mean for r in with_group_mean(df, "grp", "v").collect()}
    assert got == {1: 3.0, 2: 3.0, 3: 10.0, 4: 10.0, 5: None}


def test_load_typed_json_failfast(spark, tmp_path):
    schema = T.StructType([T.StructField("product_id", T.LongType()), T.StructField("brand", T.StringType())])
    good = tmp_path / "good.json"
    good.write_text('{"product_id": 1, "brand": "A"}\n{"product_id": 2, "brand": null}\n')
    assert rows(load_typed(spark, str(good), schema, fmt="json")) == [(1, "A"), (2, None)]
    bad = tmp_path / "bad.json"
    bad.write_text('{"product_id": "not a number", "brand": "A"}\n')
    with pytest.raises(Exception):
        load_typed(spark, str(bad), schema, fmt="json").collect()

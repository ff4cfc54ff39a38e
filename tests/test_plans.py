"""Physical-plan properties the scale design relies on."""

import re

import pytest
from conftest import sf_dir

from velocart.plans import reports as R
from velocart.plans.registry import QUERIES
from velocart.session import sizing_conf
from velocart.sources import roles
from velocart.sources.roles import SourceTables


PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan_of(spark, name, sf="0.01"):
    df = QUERIES[name](spark, sf_dir(sf))
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_or_pairwise_join_in_any_plan(spark, name):
    plan = plan_of(spark, name)
    assert not any(node in plan for node in PY_NODES)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_keep_first_limits_groups_before_the_shuffle(spark):
    plan = plan_of(spark, "keep_first")
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("Exchange hashpartitioning") == 1


def test_filters_reach_the_scan(spark):
    r8 = plan_of(spark, "r8_valuable")
    assert "EqualTo(o_orderstatus,F)" in r8
    assert "In(c_mktsegment, [BUILDING,HOUSEHOLD])" in r8
    r5 = plan_of(spark, "r5_top_customers")
    assert "In(p_brand, [Brand#1,Brand#2,Brand#3])" in r5
    # `online_order is true` in a filter reaches the scan as the IN list it is made of
    assert "In(o_orderpriority, [1-URGENT,2-HIGH])" in r5


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(spark, "r5_top_customers")
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem and all(s == "struct<l_orderkey:bigint,l_partkey:bigint>" for s in lineitem)


def test_top_k_sets_are_broadcast(spark):
    plan = plan_of(spark, "r7_top_product_buyers")
    # BroadcastExchange -> (null filter) -> TakeOrderedAndProject(limit=20)
    assert re.search(r"BroadcastExchange[^\n]*\n[^\n]*\n[^\n]*TakeOrderedAndProject\(limit=20", plan)


def test_group_mean_uses_no_window(spark):
    for name in ("group_mean_window", "above_group_mean", "r5_top_customers"):
        plan = plan_of(spark, name)
        assert "Window " not in plan and "Window(" not in plan
        assert "BroadcastHashJoin" in plan


#: Queries that store a table before they read it.
STORING = {"stored_product_new", "r1_stored_product", "r7_stored_product"}


def test_building_a_query_starts_no_job(spark):
    spark.sparkContext.setJobGroup("building", "no job may start")
    try:
        for name in sorted(set(QUERIES) - STORING):
            QUERIES[name](spark, sf_dir("0.001"))
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_no_hint_without_a_bound(spark):
    """R5 with a large k, and all reports at the size of large tables: no broadcast is forced but the top-k's."""
    t = SourceTables(spark, sf_dir("0.001"))
    frames = (
        roles.customer_valuation_role(t.customer), roles.orders_role(t.orders), roles.order_items_role(t.lineitem), roles.product_role(t.part)
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = R.top_customers(*frames, brands=("Brand#1",), k=500_000)._jdf.queryExecution()
        assert "Broadcast" not in big.executedPlan().toString()
        for name in ("r1_brand_volume", "r4a_not_exists", "r4b_except", "r8_valuable"):
            assert "Broadcast" not in plan_of(spark, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges_above(plan: str, scan: str) -> int:
    """Shuffles (not broadcasts) on the way from a scan up to the root of a printed plan."""
    lines = plan.splitlines()
    at = next(i for i, x in enumerate(lines) if scan in x and "Scan" in x)
    depth, found = len(lines[at]) - len(lines[at].lstrip(" :+-")), 0
    for x in reversed(lines[:at]):
        own = len(x) - len(x.lstrip(" :+-"))
        if own < depth:
            depth = own
            found += "Exchange hashpartitioning" in x
    return found


def test_r4_exchanges_lines_once_on_plain_tables(spark):
    """Lines go by order; what follows (product, brand) are partial rows of an aggregate."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("r4a_not_exists", "r4b_except"):
            plan = plan_of(spark, name)
            below = plan[plan.index("HashAggregate(keys=[product_id") :]
            first = below.index("partial_bool_or") if "partial_bool_or" in below else below.index("HashAggregate", 10)
            assert exchanges_above(below[first:], "l_orderkey") == 1
            # the two industries' customers meet the orders before any line does
            buyers, lines = plan.index("c_nationkey"), plan.index("l_orderkey")
            joins = [x for x in plan.splitlines() if "SortMergeJoin" in x]
            assert "LeftOuter" in joins[1] and "Inner" in joins[2] and buyers and lines
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_declared_bound_is_held_to(spark):
    """A wrong bound fails the query; it never broadcasts more rows than declared, and a right one changes nothing."""
    from velocart.operators import above_group_mean, with_group_mean

    df = spark.range(1000).selectExpr("id", "id % 50 as g", "cast(id as decimal(12,2)) as v")
    for fn in (with_group_mean, above_group_mean):
        right = sorted(fn(df, "g", "v", max_groups=50).collect())
        assert right == sorted(fn(df, "g", "v").collect())
        with pytest.raises(Exception, match="more than the declared 49 groups of g"):
            fn(df, "g", "v", max_groups=49).collect()
    # gathered behind a limit of one row more than declared
    plan = with_group_mean(df, "g", "v", max_groups=49)._jdf.queryExecution().executedPlan().toString()
    assert "LocalLimit 50" in plan and "GlobalLimit 50" in plan and "BroadcastHashJoin" in plan
    assert with_group_mean(df.filter("false"), "g", "v", max_groups=1).count() == 0


def test_latest_year_prunes_partitions(spark):
    from velocart.operators import latest_year
    from velocart.sources import create_namespace, save_table

    create_namespace(spark, "prep")
    orders = roles.orders_role(SourceTables(spark, sf_dir("0.001")).orders)
    save_table(orders, "prep.latest_by_day", mode="overwrite", partition_by=["order_date"])
    stored = spark.table("prep.latest_by_day")
    df = stored.filter(latest_year(stored, "order_date"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*order_date#\d+ >= make_date\(", plan)
    wanted = orders.selectExpr("max(year(order_date))").first()[0]
    assert df.count() == orders.filter(f"year(order_date) = {wanted}").count() > 0


def test_r8_lines_are_cut_by_a_runtime_bloom_filter(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
        **{k: v for k, v in sizing_conf(2**20, 4, filtered_side_bytes=2**30).items() if "bloomFilter" in k},
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        assert "might_contain" in plan_of(spark, "r8_valuable")
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_count_distinct_is_two_level(spark):
    plan = plan_of(spark, "r5_top_customers")
    assert "Exchange hashpartitioning(customer_id" in plan
    assert re.search(r"Exchange hashpartitioning\(customer_id#\d+L, order_id#\d+L", plan)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_query_scans_the_given_tables(spark, name):
    df = QUERIES[name](spark, sf_dir("0.01"))
    physical = df._jdf.queryExecution().sparkPlan().toString()
    assert f"file:{sf_dir('0.01')}/" in physical or (name == "stored_product_new" and "product_new_" in physical)
    assert "LocalTableScan" not in physical and "LocalRelation" not in physical

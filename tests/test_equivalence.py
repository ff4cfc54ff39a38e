"""Reports and group means against plain Python over the test tables."""

from collections import defaultdict
from decimal import Decimal

from conftest import sf_dir
from pyspark.sql import functions as F

from velocart.operators import above_group_mean, with_group_mean
from velocart.plans import reports as R
from velocart.sources import roles
from velocart.sources.roles import SourceTables


def balances(spark):
    """A NULL group and NULL values among them."""
    t = SourceTables(spark, sf_dir("0.01"))
    return t.customer.select(
        "c_custkey",
        F.when(F.col("c_custkey") % 97 == 0, F.lit(None)).otherwise(F.col("c_nationkey")).alias("g"),
        F.when(F.col("c_custkey") % 89 == 0, F.lit(None)).otherwise(F.col("c_acctbal").cast("decimal(12,2)")).alias("v"),
    )


def test_group_means(spark):
    frame = balances(spark)
    groups = defaultdict(list)
    for r in frame.collect():
        groups[r.g].append((r.c_custkey, r.v))
    sums = {g: (sum((v for _, v in x if v is not None), Decimal(0)), sum(v is not None for _, v in x)) for g, x in groups.items()}
    for bound in (None, 26):  # planned by the planner, or broadcast as declared
        got = {r.c_custkey: r.group_mean for r in with_group_mean(frame, "g", "v", max_groups=bound).collect()}
        assert got == {k: float(sums[g][0]) / sums[g][1] for g, x in groups.items() for k, _ in x}
        above = {r.c_custkey for r in above_group_mean(frame, "g", "v", bound).collect()}
        assert above == {k for g, x in groups.items() for k, v in x if v is not None and v * sums[g][1] > sums[g][0]}


def test_group_statistics_are_broadcast_only_on_a_declared_bound(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for bound, node in ((None, "SortMergeJoin"), (26, "BroadcastHashJoin"), (10**6, "SortMergeJoin")):
            assert node in above_group_mean(balances(spark), "g", "v", bound)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_r4_null_brand(spark):
    t = SourceTables(spark, sf_dir("0.01"))
    brand = F.concat(F.col("p_brand"), F.lit("/"), F.col("p_name"), F.lit("/"), F.col("p_size").cast("string"))
    frames = (
        roles.orders_role(t.orders), roles.order_items_role(t.lineitem), roles.product_role(t.part, brand=brand),
        roles.customer_industry_role(t.customer, industry=F.col("c_nationkey").cast("string")),
    )
    keep = {r.brand for r in R.bought_by_a_not_b(*frames, "3", "7", "keep").collect()}
    match = {r.brand for r in R.bought_by_a_not_b(*frames, "3", "7", "match").collect()}
    assert (len(keep), len(match)) == (332, 331) and keep - match == {None}


def test_r8_order(spark):
    t = SourceTables(spark, sf_dir("0.01"))
    got = R.valuable_customers(
        roles.customer_industry_role(t.customer), roles.orders_role(t.orders), roles.order_items_role(t.lineitem),
        industries=("BUILDING", "HOUSEHOLD"), status="F", start="1996-01-01", end="1998-01-01", min_orders=3, min_revenue=15_000_000,
    ).collect()
    keys = [(r.industry, r.customer_id) for r in got]
    assert len(keys) == 38 and keys == sorted(keys)

"""Each predicate of the composite reports matters on the test data:
changing it changes the answer (FIXTURES.md section 2), so no query is
vacuous and a dropped condition cannot go unnoticed."""

import pytest
from conftest import sf_dir
from pyspark.sql import functions as F

from velocart.plans import reports as R
from velocart.sources import roles
from velocart.sources.roles import SourceTables


@pytest.fixture(scope="module")
def t(spark):
    return SourceTables(spark, sf_dir("0.01"))


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_r1_both_thresholds_matter(t):
    p, i = roles.product_role(t.part), roles.order_items_role(t.lineitem)
    base = as_set(R.brands_by_cost_and_volume(p, i, 990, 1100))
    assert len(base) == 5
    assert as_set(R.brands_by_cost_and_volume(p, i, 0, 1100)) != base
    assert as_set(R.brands_by_cost_and_volume(p, i, 990, 0)) != base


def test_r2_each_condition_matters(t):
    o = roles.orders_from_lineitem(t.lineitem)
    base = R.daily_orders(o, "1997-04-01", "1997-04-09", "F")
    rows = base.collect()
    assert any(r.orders_count != r.count_customers for r in rows)  # distinct matters
    assert as_set(R.daily_orders(o, "1997-04-01", "1997-04-08", "F")) != as_set(base)  # closed end
    assert as_set(R.daily_orders(o, "1997-04-01", "1997-04-09", "O")) != as_set(base)  # status
    everything_online = o.withColumn("online_order", F.lit(True))
    assert as_set(R.daily_orders(everything_online, "1997-04-01", "1997-04-09", "F")) != as_set(base)


def test_r3_age_and_type_matter(t):
    c = roles.customers_from_parts(t.part, t.lineitem)
    rules = (("ECONOMY", "BLUE%"), ("STANDARD", "Small%"))
    base = sorted(r[0] for r in R.titles_by_rules(c, rules, 6, "2002-01-15").collect())
    assert len(base) == 10
    assert sorted(r[0] for r in R.titles_by_rules(c, rules, 5, "2002-01-15").collect()) != base
    other = (("PROMO", "BLUE%"), ("STANDARD", "Small%"))
    assert sorted(r[0] for r in R.titles_by_rules(c, other, 6, "2002-01-15").collect()) != base


def test_r6_each_condition_matters(t):
    c, o = roles.customer_car_role(t.customer), roles.orders_role(t.orders)
    base = as_set(R.lapsed_customers(c, o, status="F", excluded_segment="AUTOMOBILE"))
    assert len(base) == 987
    assert as_set(R.lapsed_customers(c, o, status="O", excluded_segment="AUTOMOBILE")) != base
    assert as_set(R.lapsed_customers(c, o, status="F", excluded_segment="BUILDING")) != base
    assert as_set(R.lapsed_customers(c, o, status="F", owns_car="No", excluded_segment="AUTOMOBILE")) != base
    offline = o.withColumn("online_order", ~F.col("online_order"))
    assert as_set(R.lapsed_customers(c, offline, status="F", excluded_segment="AUTOMOBILE")) != base


def test_r7_null_placement_matters(t):
    price = F.when(F.col("p_brand") == "Brand#1", F.lit(None)).otherwise(F.col("p_retailprice").cast("decimal(12,2)"))
    args = (
        roles.customer_industry_role(t.customer),
        roles.orders_role(t.orders),
        roles.order_items_role(t.lineitem),
    )
    kw = dict(line="ECONOMY", k=20, industries=("BUILDING", "MACHINERY"), min_hits=2)
    nulls_first = as_set(R.buyers_of_top_products(*args, roles.product_role(t.part, list_price=price), **kw))
    assert len(nulls_first) == 47
    # NULL prices ranked last instead (the Spark default) change the answer
    nulls_last_price = F.coalesce(price, F.lit(-1).cast("decimal(12,2)"))
    nulls_last = as_set(R.buyers_of_top_products(*args, roles.product_role(t.part, list_price=nulls_last_price), **kw))
    assert nulls_last != nulls_first


def test_r8_each_condition_matters(t):
    c = roles.customer_industry_role(t.customer)
    o, i = roles.orders_role(t.orders), roles.order_items_role(t.lineitem)
    kw = dict(industries=("BUILDING", "HOUSEHOLD"), status="F", start="1996-01-01", end="1998-01-01",
              min_orders=3, min_revenue=15_000_000)
    base = as_set(R.valuable_customers(c, o, i, **kw))
    assert len(base) == 38
    for change in ({"min_revenue": 0}, {"min_orders": 0}, {"status": "O"}):
        assert as_set(R.valuable_customers(c, o, i, **{**kw, **change})) != base

"""A task that fails mid-query is retried and the report's rows do not change.

Runs in a subprocess: the session there allows task retries (``local[4,3]``),
which the shared test session does not. A test-only Python UDF fails the
first attempt of one task that runs after a shuffle, so the retry has to
re-read shuffle output; a marker file proves the failure happened.
"""

import os
import subprocess
import sys
import textwrap

from conftest import ROOT, sf_dir

SCRIPT = textwrap.dedent(
    """
    import os, sys
    sys.path.insert(0, {root!r})
    from pyspark import TaskContext
    from pyspark.sql import functions as F, types as T
    from velocart.session import build_session
    from velocart.operators import keep_first
    from velocart.plans import reports as R
    from velocart.sources import roles

    marker = {marker!r}
    spark = build_session("local[4,3]", shuffle_partitions=4)
    spark.sparkContext.setLogLevel("OFF")

    @F.udf(T.LongType())
    def flaky(x):
        tc = TaskContext.get()
        if tc.attemptNumber() == 0 and tc.partitionId() == 1:
            open(marker + "." + str(tc.stageId()), "w").close()
            raise RuntimeError("simulated loss of a task")
        return x

    t = roles.SourceTables(spark, {sf!r})
    customer = roles.customer_industry_role(t.customer)
    orders = roles.orders_role(t.orders)
    items = roles.order_items_role(t.lineitem)
    # the UDF runs after a shuffle (reduce side of the repartition)
    shaky = orders.repartition(4, "order_id").withColumn("customer_id", flaky("customer_id"))
    kw = dict(industries=("BUILDING", "HOUSEHOLD"), status="F", start="1996-01-01", end="1998-01-01",
              min_orders=3, min_revenue=15_000_000)
    clean = sorted(tuple(r) for r in R.valuable_customers(customer, orders, items, **kw).collect())
    retried = sorted(tuple(r) for r in R.valuable_customers(customer, shaky, items, **kw).collect())
    assert clean == retried and len(clean) == 38, (len(clean), len(retried))

    lines = t.lineitem.repartition(4).withColumn("l_partkey", flaky("l_partkey"))
    order = ["l_shipdate", "l_partkey", "l_suppkey"]
    a = sorted(tuple(r) for r in keep_first(t.lineitem, ["l_orderkey", "l_linenumber"], order).collect())
    b = sorted(tuple(r) for r in keep_first(lines, ["l_orderkey", "l_linenumber"], order).collect())
    assert a == b
    print("RETRY-OK")
    """
)


def test_reports_survive_a_failed_task(tmp_path):
    marker = str(tmp_path / "failed")
    script = SCRIPT.format(root=ROOT, marker=marker, sf=sf_dir("0.01"))
    out = subprocess.run(
        [sys.executable, "-c", script], capture_output=True, text=True, timeout=600, cwd=str(tmp_path)
    )
    assert "RETRY-OK" in out.stdout, out.stderr[-3000:]
    # at least one first attempt really failed (one marker per failing stage)
    assert len([f for f in os.listdir(tmp_path) if f.startswith("failed.")]) >= 2

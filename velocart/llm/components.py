"""Connected components of an edge table, by rounds of contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velocart.llm.store import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): nodes are connected if and only if their roots agree.

    Every round each node of the contracted graph moves to its smallest
    neighbour and on to that one's; only nodes smaller than all their
    neighbours stay, at most half. Edges inside a contracted node go. Rounds
    are written to the shared folder and deleted in the end. Nothing meets on
    the driver.

    Defined results: an empty table gives no rows; loops (a = b), also of nodes
    without other edges, and nulls name no node; repeated edges count once.
    """
    edges = stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    found = nodes.withColumn("root", F.col("node"))
    first, parents = edges, []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parent = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("p"))
        up = parent.select(F.col("v").alias("p"), F.col("p").alias("pp"))
        parent = stored(parent.join(up, "p").select("v", F.col("pp").alias("p")), "parents")
        parents.append(parent)
        found = found.join(parent, F.col("root") == F.col("v"), "left").select("node", F.coalesce("p", "root").alias("root"))
        left = parent.select(F.col("v").alias("a"), F.col("p").alias("a2"))
        right = parent.select(F.col("v").alias("b"), F.col("p").alias("b2"))
        moved = edges.join(left, "a").join(right, "b").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
        before, edges = edges, stored(moved.filter("a <> b").distinct(), "edges")
        if before is not first:
            discard(before)
    out = stored(found, "roots")
    discard(first, *parents, *([] if edges is first else [edges]))
    return out

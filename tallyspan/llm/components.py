"""Connected components of an edge table, by alternating stars.

A node with a large share of all edges, as the centre of many copies has, is looked up by broadcast (there are
fewer than ``HOT_SHARE`` such nodes), so its edges stay spread over tasks.

Defined cases: repeated edges count once; an edge from a node to itself gives nothing, so a node without
another edge has no label; an edge table without rows gives no rows; null ends are not allowed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import lookup
from tallyspan.session import store_and_reload


def _least(edges: DataFrame, end: str) -> DataFrame:
    """(a, m, n): the smallest neighbour of each node, and how many edges it has."""
    found = edges.groupBy("a").agg(F.min(end).alias("m"), F.count("*").alias("n"))
    return store_and_reload(found, "least")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of ``edges`` (a, b) is connected to.

    Every edge points from its larger to its smaller end.  In turn each node hands its
    larger neighbours (large star), then its smaller ones (small star), to its smallest
    neighbour, until every edge points to a label.  Each step is two aggregations and a
    lookup of edges; nothing gathers a component, and each step is stored.
    """
    down = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    stored = store_and_reload(edges.where("a <> b").select(*down).distinct(), "edges")
    while True:
        both = stored.unionByName(stored.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least(both.withColumn("_m", F.least("a", "b")), "_m")
        large = lookup(both.where("b > a"), least, "a", "n").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = store_and_reload(large, "edges")
        joined = lookup(large, _least(large, "b"), "a", "n")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            joined.select("a", F.col("m").alias("b"))
        )
        after = store_and_reload(small.where("a <> b").distinct(), "edges")
        if not after.groupBy("a").count().where("count > 1").limit(1).count() and not (
            after.select(F.col("b").alias("a")).join(after.select("a"), "a", "left_semi").limit(1).count()
        ):
            break
        stored = after
    return after.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        after.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )

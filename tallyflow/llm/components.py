"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.llm.common import written


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    """One star step on edges (u, v), v < u.

    Large star: every node links its larger neighbours to the smallest of itself
    and its neighbours. Small star: every node links itself and its smaller
    neighbours to the smallest of them. Neighbours are never gathered: the minimum
    is a partially aggregated group, and joins the edges by node (adaptive
    execution splits a hot node's edges).
    """
    if both_ways:
        near = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges
    least = near.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    joined = near.join(least, "u")
    if both_ways:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge; component is the smallest
    node reachable. ``edges`` has long columns a and b in any order; self links,
    nulls and repeated edges don't matter. No edges: no rows."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(spark, edges, "edges")
    mark = None
    while True:
        edges = written(spark, _star(_star(edges, True), False), "stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == mark:
            break
        mark = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )

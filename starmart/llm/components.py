"""Connected components of an undirected graph, by alternating large and small star steps.

Every step points each node at the smallest neighbour it knows; the number of steps grows with the logarithm of the
longest path. No step collects edges. Each step's edges are written to the shared checkpoint folder, so lineage stays
short and a lost executor costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.session import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of ``edges`` (a, b); the component is its smallest node.

    Loops, repeated edges and nulls are allowed and add nothing.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = checkpointed(edges), None
    while True:
        edges = checkpointed(small_star(large_star(edges)))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def large_star(edges: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Links each smaller neighbour of a node, and the node, to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v"))).distinct()

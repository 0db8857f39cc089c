"""Connected components of an edge table, by hooking neighbours to the smallest node known."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm import store


def _settled(edges: DataFrame) -> bool:
    """Whether every node has at most one edge down, and none of those that others lead to has one."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.where("down > 1 OR (down = 1 AND up = 1)").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has an edge.

    In each round every node tells its neighbours the smallest node it knows of, itself
    and its neighbours included, and they are linked to that one instead. When each node
    leads to one smallest node only, that is its component. Minima are plain
    aggregations and joins, so a node with very many edges is never gathered in one task.
    """
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = store.written(edges, "edges")
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        told = both.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        told = told.unionByName(lowest.select("u", F.col("m").alias("v"))).where("u <> v")
        edges = store.written(told.distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )

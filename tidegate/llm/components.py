"""Connected components of an edge table, by alternating large-star and small-star rounds.

Every round is two aggregates with joins, so a node with very many edges never meets its
edges in one task: the least neighbour comes from a combining aggregate that is written out, and the join
back is one that adaptive execution may split. Rounds are written tables, so the lineage stays short and
a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidegate.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect each node's larger neighbours to the least node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stage(both.groupBy("u").agg(F.min("v").alias("_least")).select(
        F.col("u").alias("_u"), F.least("u", "_least").alias("_least")), "least")
    return both.join(least, both["u"] == least["_u"]).filter("v > u").select(F.col("v").alias("u"), F.col("_least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect each node and its smaller neighbours to the least of them; edges come as (larger, smaller)."""
    least = stage(edges.groupBy("u").agg(F.min("v").alias("_least")).withColumnRenamed("u", "_u"), "least")
    moved = edges.join(least, edges["u"] == least["_u"]).filter("v > _least").select(
        F.col("v").alias("u"), F.col("_least").alias("v"))
    return moved.unionByName(least.select(F.col("_u").alias("u"), F.col("_least").alias("v")))


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge down, to a node that has none."""
    down = edges.groupBy("u").agg(F.count("*").alias("n"))
    return down.filter("n > 1").isEmpty() and edges.join(down.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()


def connected_components(edges: DataFrame, label: str) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); the component is its least node."""
    ordered = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = stage(ordered, f"{label}-edges")
    while not _all_stars(now):
        now = stage(_small_star(_large_star(now)).distinct(), f"{label}-star")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

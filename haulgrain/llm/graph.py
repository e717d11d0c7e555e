"""Connected components of an edge table, by joins and aggregates alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulgrain.llm.tables import split_join, written


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One step of the alternating star algorithm on edges (u, v) with u > v.

    The large step joins every larger neighbour to the least one, the small step every smaller one.
    """
    both = edges if not larger else edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    linked = split_join(both, least, ["u"])
    if larger:
        moved = linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = linked.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            linked.select("u", F.col("m").alias("v")))
    return moved.filter("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of ``edges`` (a, b); component is the least node reachable.

    Rows with a null end or equal ends link nothing. Ends when a round leaves every edge as it was,
    after a number of rounds that grows with the logarithm of the largest component. The edges of a
    hot node are split over tasks when they are joined to its least neighbour.
    """
    edges = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(edges, "edges")
    mark = None
    while True:
        edges = written(_star(_star(edges, True), False), "stars")
        # The sums tell whether the set of edges is the same as before.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                        F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()

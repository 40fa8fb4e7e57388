"""Connected components of a graph given by its edges, by alternating large-star and small-star steps.

Each step is a grouped minimum and a join; the edges are written to the shared folder after each
round, and the rounds end when a round changes nothing. Every node ends up linked to the smallest of
its component, so a group's size never shows as a quadratic number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (a, b) with a > b."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    linked = both.join(least, "a")
    if large:
        out = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge but the roots themselves; edges: (a, b), any order."""
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        sums = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if sums == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = sums
        edges = written(_star(_star(edges, True), False), "edges")

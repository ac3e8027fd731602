"""Connected components of a graph that lives in tables, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.session import materialize


def _largest_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour, itself included."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")


def _smallest_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    linked = down.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return linked.union(least.select("a", F.col("low").alias("b"))).where("a <> b")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node with an edge; the component is its smallest node.

    ``edges`` has two integer columns ``a`` and ``b``. Each round is written to the shared
    folder, so a lost executor costs at most that round. The number of rounds grows with the
    logarithm of the graph's diameter, and a node with many edges only ever meets a partial
    minimum and a join whose large side can be split.
    """
    edges = materialize(edges.where("a <> b").select("a", "b").distinct(), "edges")
    before = None
    while True:
        edges = materialize(_smallest_star(_largest_star(edges)).distinct(), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )

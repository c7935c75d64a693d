"""Connected components by alternating stars, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import kept


def _large_star(stars: DataFrame) -> DataFrame:
    """Moves the larger neighbours of each node to the least of all its neighbours and itself.

    ``a`` is the larger end of an edge and ``b`` the smaller. A node may have a large share
    of all edges where it is the smaller end: minima combine before their shuffle, and the
    join is one that adaptive execution can split.
    """
    ends = stars.select(F.col("a").alias("node"), F.col("b").alias("least")).unionByName(
        stars.select(F.col("b").alias("node"), F.col("b").alias("least"))
    )
    least = ends.groupBy("node").agg(F.min("least").alias("least"))
    moved = stars.withColumnRenamed("b", "node").join(least, "node")
    return moved.select("a", F.col("least").alias("b"))


def _small_star(stars: DataFrame) -> DataFrame:
    """Moves the smaller neighbours of each node, and itself, to the least of them."""
    edges = stars.repartition("a")
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a")
    ends = F.explode(F.array("a", "b"))
    moved = moved.select(ends.alias("a"), F.col("least").alias("b"))
    return moved.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the least node it is connected with, of all nodes on an edge.

    ``edges`` has ``a`` and ``b`` of any ordered type; NULL ends, loops and repeats are
    ignored. Rounds grow with the logarithm of the longest path. Edges are kept in tables;
    only a count and a checksum per round come to the driver.
    """
    ends = edges.select("a", "b").where("a <> b")
    # Each edge from its larger end to its smaller one.
    stars = kept(
        ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = None
    while True:
        stars = kept(_small_star(_large_star(stars)))
        check = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        before, state = state, tuple(stars.agg(F.count("*"), check).head())
        if state == before:
            break
    nodes = stars.select(F.col("a").alias("node"), F.col("b").alias("label"))
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return nodes.unionByName(roots)

"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.scratch import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return edges.unionByName(back).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every greater neighbour of a node points to the least of its neighbourhood."""
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return around.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (its least node) of all nodes of ``edges`` (a, b).

    Each round is written to shared storage; the number of rounds grows with the
    logarithm of the longest chain. Only counts reach the driver.
    """
    current = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        size = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if tuple(size) == before:
            break
        before = tuple(size)
        current = materialize(_small_star(_large_star(current)), "edges")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)

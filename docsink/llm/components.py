"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import remove, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (large: those above it, else those below it and itself) are linked to the least one around it.

    Only minima are gathered for a node; the links of a node with very many meet its minimum in a join, which Spark can split (skew join).
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    linked = both.join(least, "a")
    if large:
        out = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(spark: SparkSession, links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node in `links` (a, b); a component's root is its least node.

    Raises if `rounds`, far more than the logarithm of the longest chain, were not enough.
    """
    edges = written(spark, links.select("a", "b").where("a <> b").distinct(), "links")
    mark = None
    for _ in range(rounds):
        new = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == mark or not new[0]:
            break
        mark = new
        before, edges = edges, written(spark, _star(_star(edges, True), False), "links")
        remove(spark, before)
    else:
        raise RuntimeError(f"the components still change after {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())

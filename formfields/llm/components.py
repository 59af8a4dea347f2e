"""Connected components of a links table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, written


def smallest_reachable(links: DataFrame) -> DataFrame:
    """node, root for every node of links (a, b): root is the smallest node reachable.

    Each round replaces the links by as many or fewer that point to smaller nodes, grouped with partial
    aggregation, so a node with very many links costs no more than its links. Rounds grow with the logarithm of a
    component's size and go on until one changes nothing; the lineage is cut by a written table each round. Links to
    nulls and of a node to itself are left out; an empty table gives no nodes. The result is a written table (see common.dropped).
    """
    edges = written(links.where("a <> b AND a IS NOT NULL AND b IS NOT NULL").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        # Large star: every larger neighbour of a node moves to the smallest of the node and its neighbours.
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: a node's smaller neighbours, and itself, move to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("x")).select(F.col("x.v").alias("u"), F.col("x.m").alias("v")).where("u <> v").distinct()
        last, edges = edges, written(small, "links")
        dropped(last)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            roots.written_at = edges.written_at
            return roots
        before = now

"""Connected components by alternating large and small stars, in O(log) rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyedflow.llm.common import saved


def _large_star(links: DataFrame) -> DataFrame:
    """Point every larger neighbour of a node at the smallest of the node and its neighbours."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return (
        both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
    ).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Point the smaller neighbours of a node, and itself, at the smallest of them. Links have u > v."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    near = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
    return near.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of every node in links ``a``, ``b``.

    Loops and repeated links are allowed, as are no links at all. A node with very many links is reduced by
    partial minima; its rows in the join are split by adaptive execution. Every round is written to the
    shared scratch folder, so that no lineage builds up.
    """
    stars = saved(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(),
        "links",
    )
    state = None
    while True:
        found = stars.agg(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor(F.xxhash64("u", "v")).alias("x"),
            F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("s"),
        ).first()
        if found == state or not found["n"]:
            break
        state = found
        stars = saved(_small_star(_large_star(stars)), "stars")
    heads = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(heads)

"""Connected components by alternating stars, with every step a join or an aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, of every node in ``a``, ``b``.

    Each round moves the links of a node to its smallest neighbour, first those to
    larger nodes, then those to smaller ones, until only stars are left. A node's
    smallest neighbour is aggregated in each task first and stored, so that the join
    back can be split where one node has very many links.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(),
        "links",
    )
    seen = state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "stars")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        turned = stored(large.distinct(), "links")
        low = stored(turned.groupBy("u").agg(F.min("v").alias("m")), "stars")
        moved = turned.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(moved.unionByName(low.withColumnRenamed("m", "v")).distinct(), "links")
        now = state(edges)
        if now == seen:
            break
        seen = now
    tips = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return tips.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def state(edges: DataFrame) -> tuple:
    """A sum over the links that tells whether a round changed them."""
    mixed = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())

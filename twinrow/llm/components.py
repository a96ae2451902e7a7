"""Connected components of a graph by star contractions.

Every node learns the smallest id it can reach. Each round turns neighbourhoods
into stars around their smallest member, first over all larger neighbours, then
over all smaller ones, until nothing changes; the number of rounds grows with
the logarithm of the longest path. Minima are aggregated before the shuffle, and
each round ends in a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinrow.llm.common import settled


def _round(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Edges (u, v) with u > v, hung to the least neighbour of one end."""
    seen = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) \
        if both_ways else edges
    least = settled(seen.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    joined = seen.join(least, "u")
    if both_ways:
        hung = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        hung = joined.select("v", "m").unionByName(joined.select(F.col("u").alias("v"), "m")) \
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, its smallest reachable node, for all nodes with edges.

    ``edges`` has long columns ``a`` and ``b``; loops and repeats are allowed,
    nulls are not.
    """
    stars = settled(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    print_of = [F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
    before = None
    while before != (now := tuple(stars.agg(*print_of).first())):
        before = now
        stars = settled(_round(settled(_round(stars, True), "stars"), False), "stars")
    nodes = stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )

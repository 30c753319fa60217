"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable from each node that has a link.

    ``links`` has two columns of one orderable type; direction, repeats and self-links do not matter.
    Every step is a grouped minimum and a join; the table of links is cut from its lineage each round.
    Nodes without a link are not returned. Empty input gives an empty table.
    """
    edges = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .where("u != v").distinct())
    edges = written(edges, "links")
    before = None
    for _ in range(max_rounds):
        # large star: every neighbour above u is linked to the smallest node around u
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())
        # small star: u and its smaller neighbours are linked to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct(), "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"links did not settle in {max_rounds} rounds")
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())

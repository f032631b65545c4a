"""Connected components of links that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace


def components(ws: Workspace, links: DataFrame, name: str) -> DataFrame:
    """(node, comp): for every node of links (a, b) the smallest node it is connected to.

    Alternating large-star and small-star steps (Kiveris et al., 2014) point all neighbours of a node at its smallest
    one until nothing changes; then all nodes of a component point at its smallest.  Each step is written to the shared folder.
    Null ends, loops and repeats are ignored; no links give no rows.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, mark, turn = ws.put(f"{name}0", edges), None, 0
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = ws.put(f"{name}{turn}l", large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()
        turn += 1
        new = ws.put(f"{name}{turn}", small.filter("u <> v"))
        ws.drop(f"{name}{turn - 1}", f"{name}{turn - 1}l")
        edges = new
        now = tuple(edges.select(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())

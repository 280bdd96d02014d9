"""Connected components of a link table, without gathering links or labels on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def connected_components(links: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(node, component) for every node of links (a, b); component is the smallest node reachable.

    Alternating star contraction: the large star hangs each node's larger neighbours on its
    smallest one, the small star does so with the smaller neighbours, until nothing moves. A
    node's minimum is pre-aggregated before each shuffle and joined back, so a node with very
    many links is split over tasks by the skew join. Null ends and self-links are ignored.
    """
    a, b = F.col("a"), F.col("b")
    edges = links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = scratch.put(edges, f"{name}-0")
    before, turn = _state(edges), 0
    while before[0]:
        turn += 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u AND v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = scratch.put(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), f"{name}-{turn}")
        scratch.drop(f"{name}-{turn - 1}")
        now = _state(edges)
        if now == before:
            break
        before = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

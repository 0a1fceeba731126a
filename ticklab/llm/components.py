"""Distributed connected components by alternating large-star and small-star steps (Kiveris et al.,
"Connected Components in MapReduce and Beyond", 2014), with DataFrame operations only.

Every step is a min-aggregation (combined on the map side) and an equi-join, so a hub with many
neighbours is pre-aggregated, and its rows in the join can be split by adaptive skew handling. Each
round's edges go to the shared folder; rounds end when the edge set no longer changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklab.llm.common import discard, staged


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges``; component is the smallest node reachable.

    Edges are undirected; null ends and self-loops add nothing (a node that only has a self-loop is
    not returned). Repeated edges count once. An empty table gives an empty result. Node type: any
    ordered type.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    cur = staged(pairs.where("u is not null and v is not null and u <> v").distinct(), "cc")
    mark = _mark(cur)
    while mark[0]:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        large = staged(large, "cc")
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = staged(small.unionByName(low2.select("u", F.col("m").alias("v"))).distinct(), "cc")
        new = _mark(nxt)
        discard(large)
        discard(cur)
        cur, done, mark = nxt, new == mark, new
        if done:
            break
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _mark(df: DataFrame) -> tuple:
    """Count and order-free checksum of the edges: equal marks mean that a round changed nothing."""
    return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

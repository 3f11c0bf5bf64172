"""Connected components of a graph held as a table of edges.

Alternating star steps: every node points its larger neighbours to its smallest one, then every
node points its smaller neighbours there. Each step is a minimum per node, which combines before
the shuffle, and a join back; neither gathers the neighbours of a node. Edges stay in tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

MAX_STEPS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _to_smallest(pairs: DataFrame) -> DataFrame:
    """(u, v) with the smallest of u and its v per u, as ``m``."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return pairs.join(least, "u")


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
                    .alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for every node with an edge.

    ``edges`` has bigint columns u and v, in any direction; repeated edges, loops and nulls are
    harmless. After each pair of steps the edges are written to the shared folder.
    """
    now = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                                   F.least("u", "v").alias("v")).distinct())
    seen = _state(now)
    for _ in range(MAX_STEPS):
        large = _to_smallest(_both_ways(now)).where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _to_smallest(large.where("u > v"))
        now = materialise(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                          .unionByName(small.select("u", F.col("m").alias("v")))
                          .where("u <> v").distinct())
        state = _state(now)
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)

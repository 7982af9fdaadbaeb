"""Connected components of an edge table, by alternating large-star and small-star rounds.

Each round is two aggregations and two joins over the edges; its result is written to the
shared folder, so a lost executor costs a round at most. No group is gathered: a node with
very many neighbours is reduced by a partial minimum, and its edges stay rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"),
                  F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` of every node in ``edges``; a component is named by its smallest node.

    Null ends and loops are dropped; repeated edges count once. Without edges the result is empty.
    """
    a, b = F.col(a), F.col(b)
    e = edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    e = stored(e.distinct(), "edges")
    state = _state(e)
    while True:
        # large star: every larger neighbour of a node moves to the node's smallest neighbour
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours move to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        e = stored(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        new = _state(e)
        if new == state:
            break
        state = new
    root = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return root.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()

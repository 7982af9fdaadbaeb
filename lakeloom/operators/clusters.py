"""Connected components, and clusters of near-duplicate texts.

``connected_components`` alternates large-star and small-star steps (each vertex links its larger, then its smaller
neighbours to the least of them) until every component is a star around its least id. Each step is an aggregate and a join,
and each round is written to the shared folder.

``near_duplicate_clusters`` joins texts whose word-shingle sets have a Jaccard similarity of ``threshold`` or more:

1. Texts with the same set are one; the least id stands for all of them.
2. Sets that share a band of their MinHash signature meet in a bucket. Every member is first compared with the
   bucket's least id (a star: linear in the bucket, however hot), exactly, on the shingles.
3. Members that aren't alike to that id are compared with the whole bucket, in blocks of bounded size, unless the
   first links have put both into one component. Signatures choose the pairs, shingles decide.
4. Components over all links.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators import vector as vx
from lakeloom.session import stored

#: A pair goes on to the exact comparison if its signatures agree on this much less than the threshold: over five
#: standard deviations of the estimate from 128 hashes.
MARGIN = 0.2
#: Ids that may be broadcast to pick their sets; with more all sets are shuffled.
BROADCAST_IDS = 500_000


def _links(edges: DataFrame) -> DataFrame:
    """``u > v``, each once."""
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _links(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _links(linked.unionByName(least.select("u", F.col("m").alias("v"))))


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``id, component`` of every vertex of the edges; the component is its least id."""
    now = stored(_links(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "edges")
    mark = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
        now = stored(_small_star(_large_star(now)), "edges")
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def _of(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """``sets`` without rows that a join with ``ids`` (a column ``id``) would drop, if the ids are few: wide rows that nobody
    asks for aren't shuffled."""
    ids = ids.distinct()
    return sets.join(F.broadcast(ids), "id", "left_semi") if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else sets


def _alike(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``u, v`` whose shingle sets are similar enough, compared exactly."""
    pairs, sets = stored(pairs, "pairs"), sets.select("id", "shingles")
    left = _of(sets, pairs.select(F.col("u").alias("id"))).select(F.col("id").alias("u"), F.col("shingles").alias("su"))
    right = _of(sets, pairs.select(F.col("v").alias("id"))).select(F.col("id").alias("v"), F.col("shingles").alias("sv"))
    x = pairs.join(left, "u").join(right, "v").withColumn("n", F.size(F.array_intersect("su", "sv")))
    return x.where(F.col("n") >= threshold * (F.size("su") + F.size("sv") - F.col("n"))).select("u", "v")


def _candidates(least: float):
    """Pairs of a block that share a bucket (the first number of a vector), whose components (the second) differ and whose
    signatures agree enough."""
    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(left) and len(right):
            u, v = left["query_id"].to_numpy(dtype="int64"), right["vec_id"].to_numpy(dtype="int64")
            a, b = np.stack(left["qvec"].to_numpy()), np.stack(right["vec"].to_numpy())
            order = np.argsort(b[:, 0], kind="stable")
            v, b = v[order], b[order]
            lows, highs = np.searchsorted(b[:, 0], a[:, 0], "left"), np.searchsorted(b[:, 0], a[:, 0], "right")
            for x, row, lo, hi in zip(u, a, lows, highs, strict=True):
                agree = (b[lo:hi, 2:] == row[2:]).mean(axis=1)
                found = v[lo:hi][(agree >= least) & (b[lo:hi, 1] != row[1])]
                us.append(np.maximum(x, found))
                vs.append(np.minimum(x, found))
        return pd.DataFrame({"u": np.concatenate(us), "v": np.concatenate(vs)})

    return compare


def near_duplicate_clusters(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, bands: int = 32,
                            rows_per_band: int = 4, shingle: int = 5, block_rows: int = 1000, partitions: int | None = None) -> DataFrame:
    """``id, cluster`` of every id: the least id that links of near-duplicate texts lead to (its own without any).

    Texts are split at everything but letters, digits and underscores, in lower case; a text of fewer words than ``shingle`` is one
    shingle, one without words is like no other. A pair at the threshold shares a band with a chance of
    ``1 - (1 - threshold ** rows_per_band) ** bands``, 0.9999999 by default.
    """
    ids = df.select(F.col(id_col).alias("id")).where("id IS NOT NULL").distinct()
    signed = vx.minhash_signatures(df, id_col, text_col, shingle, bands * rows_per_band, partitions)
    signed = stored(signed.select("id", "shingles", "sig", F.xxhash64("shingles").alias("h1"), F.xxhash64(F.lit(1), "shingles").alias("h2")), "signatures")
    signed = signed.where(F.size("shingles") > 0)
    sets = signed.groupBy("h1", "h2").agg(F.min("id").alias("id"), F.min_by(F.struct("shingles", "sig"), "id").alias("s"))
    sets = stored(sets.select("h1", "h2", "id", "s.shingles", "s.sig"), "sets")
    copies = signed.select("id", "h1", "h2").join(sets.select("h1", "h2", F.col("id").alias("v")), ["h1", "h2"]).select(F.col("id").alias("u"), "v")

    band = lambda k: F.xxhash64(F.lit(k), F.slice("sig", k * rows_per_band + 1, rows_per_band))
    buckets = sets.select("id", F.explode(F.array(*[band(k) for k in range(bands)])).alias("bucket"))
    centers = buckets.groupBy("bucket").agg(F.min("id").alias("center"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stored(buckets.join(centers, "bucket").select("bucket", "id", "center", "n"), "members")
    spokes = members.where("id <> center").select(F.col("id").alias("u"), F.col("center").alias("v")).distinct()
    near = stored(_alike(spokes, sets, threshold), "links")

    # who isn't alike to the center asks the whole bucket
    asks = members.where("id <> center").join(near.select(F.col("u").alias("id"), F.col("v").alias("center")), ["id", "center"], "left_anti")
    asks = stored(asks.select("bucket", "id", "n"), "asks")
    parts = connected_components(near, "u", "v").withColumnRenamed("component", "part")
    asked = stored(members.join(asks.select("bucket").distinct(), "bucket", "left_semi").select("bucket", "id", "n"), "asked")
    labelled = _of(sets.select("id", "sig"), asked.select("id")).join(parts, "id", "left").select("id", F.coalesce("part", "id").cast("bigint").alias("part"), "sig")
    # buckets smaller than a block share blocks: a group of its own for each would cost far more than its comparisons
    groups = max(1, math.ceil(asked.where(F.col("n") <= block_rows).count() / block_rows))
    place = F.when(F.col("n") <= block_rows, F.pmod(F.xxhash64("bucket"), F.lit(groups))).otherwise(F.col("bucket")).alias("list_id")
    vec = F.concat(F.array("bucket", "part"), F.col("sig")).alias("vec")
    q = asks.join(labelled, "id").select(place, F.col("id").alias("query_id"), vec)
    b = asked.join(labelled, "id").select(place, F.col("id").alias("vec_id"), vec)
    qq, bb, keys = vx._blocked_groups(q, b, block_rows)
    rest = qq.groupBy(*keys).cogroup(bb.groupBy(*keys)).applyInPandas(_candidates(threshold - MARGIN), "u bigint, v bigint")
    more = _alike(rest.distinct(), sets, threshold)

    linked = copies.where("u <> v").unionByName(near).unionByName(more)
    found = connected_components(linked, "u", "v")
    return ids.join(found, "id", "left").select("id", F.coalesce("component", "id").alias("cluster"))

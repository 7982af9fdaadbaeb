"""Exact similarity join by angles: cells around pivots instead of all pairs.

Every row lives in the cell of its nearest pivot. A pair no further apart than ``t`` (an angle) with homes in two
cells is found in the cell with the smaller number: the other row visits it. A row ``y`` with home pivot ``q`` needs to visit cell ``p`` only if

* ``angle(y, p) - t <= radius(p)``, else no row of the cell is near enough, and
* ``angle(y, p) <= angle(y, q) + 2 t``: a row ``x`` of the cell is at least as near to ``p`` as to ``q``, so by the triangle
  inequality ``angle(y, p) <= angle(y, x) + angle(x, p) <= t + angle(x, q) <= 2 t + angle(y, q)``.

Rows travel in blocks: neighbouring cells share one, a hot cell is cut into several, so neither it nor a hot group of copies
fills a task. A visitor is sent once to a block, with the numbers of the cells that it visits there, and is compared with these cells
alone. How much the bounds save depends on the data and the distance: :func:`examined` tells the pairs that were compared.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators import vector as vx
from lakeloom.session import shared_dir

#: Added to an angle before a cell is ruled out: far above rounding errors.
EPSILON = 1e-7
PAIRS = "id_a bigint, id_b bigint, similarity double"


class Cells(NamedTuple):
    """``homes``: cell, id, vec, angle of every row. ``sizes``: rows of each cell. ``visits``: of some rows of ``homes``, the
    other cells that each must visit (rows by cells)."""

    homes: DataFrame
    sizes: np.ndarray
    visits: Callable[[pd.DataFrame], np.ndarray]


def pivots(df: DataFrame, count: int, seed: int = 42) -> DataFrame:
    """``cell, vec`` of ``count`` rows chosen by a hash of their vector; any choice gives the same pairs."""
    some = df.select("vec").distinct().orderBy(F.xxhash64(F.lit(seed), "vec"), "vec").limit(count)
    rows = [r["vec"] for r in some.collect()]  # ``count`` rows
    return df.sparkSession.createDataFrame(list(enumerate(rows)), "cell int, vec array<double>")


def cells(df: DataFrame, around: DataFrame, max_angle: float) -> Cells:
    """Deals ``id, vec`` rows to the cells of the ``around`` pivots and to those they must visit."""
    spark = df.sparkSession
    size = around.agg(F.sum(8 * F.size("vec"))).first()[0] or 0
    if size > vx.MAX_CENTROID_BYTES:
        raise ValueError(f"{size} bytes of pivots are too many to broadcast; take fewer")
    centers = spark.sparkContext.broadcast(vx._matrix(around.orderBy("cell").toPandas()["vec"]))  # size checked above

    def angles(pdf: pd.DataFrame) -> np.ndarray:
        return np.arccos(np.clip(vx._matrix(pdf["vec"]) @ centers.value.T, -1.0, 1.0))

    def settle(batches):
        for pdf in vx.in_parts(batches, len(centers.value)):
            a = angles(pdf)
            cell = a.argmin(axis=1)
            yield pd.DataFrame({"cell": cell.astype("int32"), "id": pdf["id"], "vec": pdf["vec"], "angle": a[np.arange(len(a)), cell]})

    path = shared_dir(spark, "cells")
    settled = df.mapInPandas(settle, f"cell int, id bigint, vec {df.schema['vec'].dataType.simpleString()}, angle double")
    settled.write.parquet(path)
    homes = spark.read.schema(settled.schema).parquet(path)
    found = homes.groupBy("cell").agg(F.max("angle").alias("radius"), F.count(F.lit(1)).alias("n")).toPandas()  # one row a pivot
    at = found["cell"].to_numpy(dtype=int)
    radii, sizes = np.full(len(centers.value), -np.inf), np.zeros(len(centers.value), dtype="int64")
    radii[at], sizes[at] = found["radius"].to_numpy(), found["n"].to_numpy()
    radii = spark.sparkContext.broadcast(radii)

    def visits(pdf: pd.DataFrame) -> np.ndarray:
        a = angles(pdf)
        near = (a - max_angle <= radii.value + EPSILON) & (a <= pdf["angle"].to_numpy()[:, None] + 2 * max_angle + EPSILON)
        return near & (np.arange(a.shape[1])[None, :] < pdf["cell"].to_numpy()[:, None])

    return Cells(homes, sizes, visits)


def _sent(dealt: Cells, groups: np.ndarray, parts: np.ndarray):
    """Of rows of ``homes`` with their block: ``(block, rows, cells)`` for each block where some of them are compared, the
    rows' places and the cells that each meets there."""
    visits, count = dealt.visits, len(dealt.sizes)
    first = np.concatenate([[0], np.cumsum(parts)])
    ends = np.searchsorted(groups, np.arange(len(parts) + 1))

    def sent(pdf: pd.DataFrame):
        near = visits(pdf)
        near[np.arange(len(pdf)), pdf["cell"].to_numpy()] = True
        for g, many in enumerate(parts):
            some = near[:, ends[g]:ends[g + 1]]
            rows = np.flatnonzero(some.any(axis=1))
            if not len(rows):
                continue
            at, cell = np.nonzero(some[rows])
            cells = np.split((cell + ends[g]).astype("int32"), np.flatnonzero(np.diff(at)) + 1)
            for block in range(first[g], first[g] + many):
                # blocks of one cell meet once
                ahead = np.flatnonzero((block <= pdf["block"].to_numpy()[rows]) | (pdf["cell"].to_numpy()[rows] >= ends[g + 1]))
                if len(ahead):
                    yield block, rows[ahead], [cells[i] for i in ahead]

    return sent, count


def _compare(min_sim: float, block_rows: int):
    def compare(key: tuple, home: pd.DataFrame, guest: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"id_a": pd.Series([], dtype="int64"), "id_b": pd.Series([], dtype="int64"), "similarity": pd.Series([], dtype="float64")})]
        if not len(home) or not len(guest):
            return found[0]
        a, b = home["id"].to_numpy(dtype="int64"), guest["gid"].to_numpy(dtype="int64")
        x, y = vx._matrix(home["vec"]), vx._matrix(guest["gvec"])
        lives, visited = guest["gcell"].to_numpy(), np.concatenate(guest["cells"].to_list())
        visitor = np.repeat(np.arange(len(guest)), guest["cells"].map(len))
        by_cell = np.argsort(visited, kind="stable")
        visited, visitor = visited[by_cell], visitor[by_cell]
        for cell, own in home.groupby("cell").indices.items():
            come = visitor[slice(*np.searchsorted(visited, [cell, cell + 1]))]
            for p in range(0, len(own), block_rows):
                for q in range(0, len(come), block_rows):
                    h, g = own[p:p + block_rows], come[q:q + block_rows]
                    s = x[h] @ y[g].T
                    i, j = np.nonzero(s >= min_sim)
                    if key[0] == key[1]:  # a cell's rows against themselves: each pair once
                        once = (lives[g[j]] != cell) | (a[h[i]] < b[g[j]])
                        i, j = i[once], j[once]
                    u, v = a[h[i]], b[g[j]]
                    found.append(pd.DataFrame({"id_a": np.minimum(u, v), "id_b": np.maximum(u, v), "similarity": s[i, j]}))
        return pd.concat(found)

    return compare


def similar_pairs(df: DataFrame, id_col: str = "vec_id", vec: str = "embedding", max_dist: float = 0.5, count: int | None = None,
                  block_rows: int = 2000) -> DataFrame:
    """All pairs ``id_a < id_b`` with a cosine distance of ``max_dist`` at most, each once (ids are unique)."""
    dealt, most = dealt_cells(df, id_col, vec, max_dist, count), vx.GROUP_BLOCKS * block_rows
    groups = vx.packed(dealt.sizes, most)
    rows = np.bincount(groups, dealt.sizes) if len(groups) else np.zeros(0)
    parts = np.maximum(1, np.ceil(rows / most)).astype(int)  # only a hot cell has several
    first = np.cumsum(parts) - parts
    sent, width = _sent(dealt, groups, parts)
    plan = df.sparkSession.createDataFrame([(c, int(first[g]), int(parts[g])) for c, g in enumerate(groups)], "cell int, first int, parts int")
    block = F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))
    homes = dealt.homes.join(F.broadcast(plan), "cell").select(block.cast("int").alias("block"), "cell", "id", "vec", "angle")  # one row a cell

    def meet(batches):
        for pdf in vx.in_parts(batches, width):
            for number, at, _ in sent(pdf):
                chunks = np.unique(pdf["block"].to_numpy()[at])
                yield pd.DataFrame({"block": np.full(len(chunks), number, "int32"), "chunk": chunks})

    def visit(batches):
        for pdf in vx.in_parts(batches, width):
            for number, at, cells_ in sent(pdf):
                x = pdf.iloc[at]
                yield pd.DataFrame({"block": np.full(len(at), number, "int32"), "chunk": x["block"].to_numpy(), "gcell": x["cell"].to_numpy(),
                                    "gid": x["id"].to_numpy(), "gvec": x["vec"].to_numpy(), "cells": pd.Series(cells_, dtype=object)})

    meetings = homes.mapInPandas(meet, "block int, chunk int").distinct()  # pairs of blocks
    kind = homes.schema["vec"].dataType.simpleString()
    guests = homes.mapInPandas(visit, f"block int, chunk int, gcell int, gid bigint, gvec {kind}, cells array<int>")
    hosts = homes.select("block", "cell", "id", "vec").join(meetings, "block")
    return hosts.groupBy("block", "chunk").cogroup(guests.groupBy("block", "chunk")).applyInPandas(_compare(1.0 - max_dist, block_rows), PAIRS)


def dealt_cells(df: DataFrame, id_col: str, vec: str, max_dist: float, count: int | None = None) -> Cells:
    # floats stay floats on their way; they are compared as doubles
    kind = "array<float>" if df.schema[vec].dataType.simpleString() == "array<float>" else "array<double>"
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec).cast(kind).alias("vec"))
    # a vector that is null, has a null or non-finite component or no length is like no other
    fine = F.exists("vec", lambda x: x != 0) & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.coalesce(fine, F.lit(False)))
    count = count or max(1, math.isqrt(max(1, df.count())))
    around = pivots(rows.withColumn("vec", F.col("vec").cast("array<double>")), count)
    return cells(rows, around, math.acos(min(1.0, max(-1.0, 1.0 - max_dist))))


def examined(dealt: Cells) -> DataFrame:
    """One row: rows, cells, visits, the pairs compared and the share of all pairs they are."""
    visits, width = dealt.visits, len(dealt.sizes)

    def count(batches):
        for pdf in vx.in_parts(batches, width):
            g = visits(pdf).sum(axis=0)
            at = np.flatnonzero(g)
            yield pd.DataFrame({"cell": at.astype("int32"), "g": g[at].astype("int64")})

    home = dealt.homes.groupBy("cell").agg(F.count(F.lit(1)).alias("h"))
    guest = dealt.homes.mapInPandas(count, "cell int, g bigint").groupBy("cell").agg(F.sum("g").alias("g"))
    x = home.join(guest, "cell", "left").fillna(0, ["g"])
    x = x.agg(F.sum("h").alias("rows"), F.count(F.lit(1)).alias("cells"), F.sum("g").alias("visits"),
              F.sum(F.col("h") * (F.col("h") - 1) / 2 + F.col("h") * F.col("g")).cast("bigint").alias("pairs_examined"))
    return x.withColumn("share_of_all_pairs", F.col("pairs_examined") / (F.col("rows") * (F.col("rows") - 1) / 2))

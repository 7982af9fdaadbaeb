"""A stored IVF index: fitted once, refreshed by appends and tombstones, searched by angle bounds.

An index is a folder of Parquet tables:

* ``centroids`` — one row per list, written by the build and never changed;
* ``rows/refresh=N/list_id=L`` — the vectors that refresh N added, with their angle to the centroid;
* ``lists/refresh=N`` — per list the rows added and the range of their angles (the list's inner and outer radius);
* ``tombstones/refresh=N`` — ids whose older rows are dead since refresh N;
* ``manifest/refresh=N`` — one row with the time and counts, written last.

A refresh counts once its manifest row is there: readers take the folders up to the newest (or a given) version, and a
refresh that broke off is overwritten by the next. A changed vector is a tombstone and a new row.

Search goes by angles, which obey the triangle inequality: a row of a list whose centroid is ``a`` away from the query, and whose
rows are ``lo`` to ``hi`` away from the centroid, is at least ``max(0, a - hi, lo - a)`` away. Lists are probed in the order of
this bound. *Exact* search takes the first few, and then every list whose bound doesn't exceed the k-th angle found
so far; no other list can hold a better row. With ``nprobe`` the first lists alone are searched;
:func:`tune_probes` finds the number that reaches a recall on a sample of queries.

Vectors are stored as floats. Rows whose vector is null, has a null or non-finite component or no length have no
angle: they are neither indexed nor counted.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.operators import tiles
from lakeloom.operators import vector as vx
from lakeloom.session import path_exists, spread_scan, stored
from lakeloom.sources.sinks import rebalanced

#: Added to an angle before a list is ruled out: far above rounding errors, far below any difference that matters.
EPSILON = 1e-7
#: Bytes of stored vectors that a task of a search reads.
TASK_BYTES = 32 << 20
#: Rows from which a fit is dealt to all cores if its files aren't; another deal starts the fit from other rows.
FIT_ROWS = 100_000
ROWS = "vec_id bigint, embedding array<float>, angle double, h bigint"


class Found(NamedTuple):
    """``hits``: query_id, vec_id, score, rank. ``probes``: query_id, list_id of every list looked into; ``looked``: query_id, n lists."""

    hits: DataFrame
    probes: DataFrame
    looked: DataFrame


class _Lists(NamedTuple):
    ids: np.ndarray
    centroids: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    rows: np.ndarray

    def angles(self, vectors: pd.Series) -> np.ndarray:
        return np.arccos(np.clip(vx._matrix(vectors) @ self.centroids.T, -1.0, 1.0))

    def bounds(self, vectors: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        """Least angle to a row of each list, and the lists in the order they are probed."""
        a = self.angles(vectors)
        bound = np.maximum(0.0, np.maximum(a - self.hi, self.lo - a))
        return bound, np.lexsort((np.broadcast_to(self.ids, a.shape), a, bound), axis=1)

    def near(self, vectors: pd.Series, first: int) -> tuple[np.ndarray, np.ndarray]:
        """Least angle to a row of each list, and whether the list is one of the ``first`` that are probed."""
        a = self.angles(vectors)
        bound = np.maximum(0.0, np.maximum(a - self.hi, self.lo - a))
        if first >= a.shape[1]:
            return bound, np.ones(a.shape, bool)
        last = np.partition(bound, first - 1, axis=1)[:, first - 1:first]
        sure = bound < last
        a[bound != last] = np.inf  # of lists with the same bound the nearest centroids come first
        left = first - sure.sum(axis=1)
        among = np.sort(a, axis=1)[np.arange(len(a)), left - 1]
        near = sure | (a <= among[:, None])
        for i in np.flatnonzero(near.sum(axis=1) > first):  # centroids as far as one another, by id
            near[i] = sure[i]
            near[i, np.lexsort((self.ids, a[i]))[:left[i]]] = True
        return bound, near


def _with_direction(df: DataFrame, id_col: str, vec: str) -> DataFrame:
    """``vec_id, embedding, h`` of the rows that have an angle; ``h`` tells a changed vector."""
    x = df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec).cast("array<float>").alias("embedding"))
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists("embedding", lambda v: v != 0)
    return x.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False))).withColumn("h", F.xxhash64("embedding"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per refresh: refresh (0 is the build), refreshed_at, base_rows, added, removed."""
    return spark.read.schema("refresh int, refreshed_at timestamp, base_rows bigint, added bigint, removed bigint").parquet(f"{path}/manifest")


def version(spark: SparkSession, path: str) -> int:
    """The newest finished refresh; -1 if there is no index."""
    if not path_exists(spark, f"{path}/manifest"):
        return -1
    return manifest(spark, path).agg(F.max("refresh")).first()[0]


def _parts(spark: SparkSession, path: str, table: str, schema: str, having: str, upto: int) -> DataFrame:
    """A table's folders up to a version, of those refreshes that wrote any (one manifest row each)."""
    some = manifest(spark, path).where((F.col("refresh") <= upto) & (F.col(having) > 0)).select("refresh").collect()
    empty = spark.createDataFrame([], f"{schema}, refresh int")
    if not some:
        return empty
    folders = [f"{path}/{table}/refresh={r[0]}" for r in some]
    return spark.read.schema(empty.schema).option("basePath", f"{path}/{table}").parquet(*folders)


def live_rows(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """``vec_id, embedding, angle, h, list_id`` of the rows that no later tombstone has killed."""
    upto = version(spark, path) if upto is None else upto
    rows = _parts(spark, path, "rows", f"{ROWS}, list_id int", "added", upto)
    dead = _parts(spark, path, "tombstones", "vec_id bigint", "removed", upto)
    dead = dead.groupBy("vec_id").agg(F.max("refresh").alias("died"))
    return rows.join(dead, (rows["vec_id"] == dead["vec_id"]) & (rows["refresh"] < dead["died"]), "left_anti").drop("refresh")


def lists(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """``list_id, centroid, lo, hi, rows``: each list with the range of its rows' angles (rows ever added)."""
    upto = version(spark, path) if upto is None else upto
    ranges = _parts(spark, path, "lists", "list_id int, lo double, hi double, rows bigint", "added", upto)
    ranges = ranges.groupBy("list_id").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("rows").alias("rows"))
    return spark.read.parquet(f"{path}/centroids").join(ranges, "list_id")


def _collected(table: DataFrame) -> _Lists:
    """The lists as arrays, after a check of their bytes (one row a list)."""
    size = table.agg(F.sum(8 * F.size("centroid"))).first()[0] or 0
    if size > vx.MAX_CENTROID_BYTES:
        raise ValueError(f"{size} bytes of centroids are too many to broadcast; build fewer lists")
    pdf = table.orderBy("list_id").toPandas()
    bounds = [pdf[c].to_numpy(dtype="float64") if c in pdf else np.zeros(len(pdf)) for c in ("lo", "hi", "rows")]
    return _Lists(pdf["list_id"].to_numpy(dtype="int64"), vx._matrix(pdf["centroid"]), *bounds)


def _assigned(rows: DataFrame, centroids: DataFrame) -> DataFrame:
    """Each row's nearest list and its angle to the centroid."""
    known = rows.sparkSession.sparkContext.broadcast(_collected(centroids))

    def nearest(batches):
        for pdf in vx.in_parts(batches, len(known.value.ids)):
            a = known.value.angles(pdf["embedding"])
            at = a.argmin(axis=1) if len(pdf) else np.zeros(0, int)
            yield pdf.assign(angle=a[np.arange(len(pdf)), at], list_id=known.value.ids[at].astype("int32"))[
                ["vec_id", "embedding", "angle", "h", "list_id"]]

    return rows.mapInPandas(nearest, f"{ROWS}, list_id int")


def _commit(spark: SparkSession, path: str, number: int, new: DataFrame, gone: DataFrame | None, now: str, base_rows: int) -> None:
    """Writes one refresh: rows, ranges, tombstones, and last its manifest row."""
    def write(df: DataFrame, table: str, *by: str) -> str:
        target = f"{path}/{table}/refresh={number}"
        out = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (out.partitionBy(*by) if by else out).parquet(target)
        return target

    target = write(rebalanced(_assigned(new, spark.read.parquet(f"{path}/centroids")), "list_id"), "rows", "list_id")
    written = spark.read.schema(spark.createDataFrame([], f"{ROWS}, list_id int").schema).parquet(target)
    write(written.groupBy("list_id").agg(F.min("angle").alias("lo"), F.max("angle").alias("hi"), F.count(F.lit(1)).alias("rows")), "lists")
    removed = 0
    if gone is not None:
        removed = spark.read.schema("vec_id bigint").parquet(write(gone.select("vec_id").distinct(), "tombstones")).count()
    row = spark.range(1).select(F.lit(now).cast("timestamp").alias("refreshed_at"), F.lit(base_rows).cast("bigint").alias("base_rows"),
                                F.lit(written.count()).cast("bigint").alias("added"), F.lit(removed).cast("bigint").alias("removed"))
    write(row, "manifest")


def build_index(base: DataFrame, path: str, num_lists: int, now: str, seed: int = 42, max_iter: int = 20,
                id_col: str = "vec_id", vec: str = "embedding") -> str:
    """Fits the lists once, stores ``base`` in them as refresh 0 and returns ``path``."""
    spark = base.sparkSession
    if version(spark, path) >= 0:
        raise ValueError(f"{path} holds an index already; refresh it")
    rows = _with_direction(base, id_col, vec)
    count = rows.count()
    if count >= FIT_ROWS:
        rows = spread_scan(rows)
    _, centroids = vx.build_ivf(rows, num_lists, seed, max_iter=max_iter)
    centroids.write.mode("overwrite").parquet(f"{path}/centroids")
    _commit(spark, path, 0, rows, None, now, count)
    return path


def refresh_index(base: DataFrame, path: str, now: str, id_col: str = "vec_id", vec: str = "embedding") -> int:
    """Brings the stored lists up to ``base`` without a new fit; returns the new version.

    Rows that are new or changed are appended to their nearest list, ids that are gone or changed get a tombstone.
    """
    spark = base.sparkSession
    last = version(spark, path)
    if last < 0:
        raise ValueError(f"{path} holds no index; build it")
    rows = _with_direction(base, id_col, vec)
    live = live_rows(spark, path, last).select("vec_id", "h")
    _commit(spark, path, last + 1, rows.join(live, ["vec_id", "h"], "left_anti"),
            live.join(rows.select("vec_id", "h"), ["vec_id", "h"], "left_anti"), now, rows.count())
    return last + 1


def status(base: DataFrame, path: str, upto: int | None = None, id_col: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """One row on how far the index is behind ``base``.

    ``indexed_rows`` are rows of ``base`` that are in the index as they are, ``pending_rows`` those that aren't,
    ``stale_rows`` index rows that ``base`` no longer has. The index is ready when it covers anything and has a refresh time.
    """
    spark = base.sparkSession
    upto = version(spark, path) if upto is None else upto
    live = live_rows(spark, path, upto).select("vec_id", "h").withColumn("i", F.lit(1))
    both = _with_direction(base, id_col, vec).select("vec_id", "h").withColumn("b", F.lit(1)).join(live, ["vec_id", "h"], "full_outer")
    made = manifest(spark, path).where(F.col("refresh") <= upto).agg(
        F.max("refreshed_at").alias("last_refresh_time"), F.max("refresh").cast("bigint").alias("refreshes"))
    counted = both.agg(
        F.count("b").alias("base_rows"), F.count(F.when(F.col("b").isNotNull(), F.col("i"))).alias("indexed_rows"),
        F.count(F.when(F.col("i").isNull(), F.col("b"))).alias("pending_rows"),
        F.count(F.when(F.col("b").isNull(), F.col("i"))).alias("stale_rows"))
    x = counted.crossJoin(made)  # one row each
    share = F.when(F.col("base_rows") > 0, F.col("indexed_rows") * 100.0 / F.col("base_rows")).otherwise(F.lit(0.0))
    return x.select("refreshes", "last_refresh_time", "base_rows", "indexed_rows", "pending_rows", "stale_rows",
                    share.alias("coverage_percentage"),
                    F.when((share > 0) & F.col("last_refresh_time").isNotNull(), "READY").otherwise("NOT READY").alias("index_status"))


# --- search --------------------------------------------------------------------------------------------------------

def _queries(queries: DataFrame, query_id: str, vec: str) -> DataFrame:
    x = _with_direction(queries, query_id, vec)
    return x.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vec"))


def _probes(queries: DataFrame, known, first: int, beyond: bool = False) -> DataFrame:
    """``query_id, lists, n``: a bit for each of the first lists in probe order, or, ``beyond`` them, of those within the query's
    ``reach``; and how many they are."""
    def probe(batches):
        for pdf in vx.in_parts(batches, len(known.value.ids)):
            bound, wanted = known.value.near(pdf["vec"], first)
            if beyond:
                wanted = ~wanted & (bound <= pdf["reach"].to_numpy()[:, None] + EPSILON)
            bits = [x.tobytes() for x in np.packbits(wanted, axis=1)]
            yield pd.DataFrame({"query_id": pdf["query_id"], "lists": pd.Series(bits, dtype=object), "n": wanted.sum(axis=1)})

    return queries.mapInPandas(probe, "query_id bigint, lists binary, n bigint")


def _bits(lists, count: int) -> np.ndarray:
    """A row of ``count`` booleans for each of some strings of bits."""
    return np.unpackbits(np.frombuffer(b"".join(lists), "u1").reshape(len(lists), -1), axis=1, count=count).astype(bool)


def _asked(probes: DataFrame, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether anyone probes each list, and how many queries each group of lists has."""
    begins = np.flatnonzero(np.diff(groups, prepend=-1))

    def count(batches):
        for pdf in vx.in_parts(batches, len(groups)):
            bits = _bits(pdf["lists"], len(groups))
            n = np.concatenate([bits.any(axis=0), np.logical_or.reduceat(bits, begins, axis=1).sum(axis=0)])
            yield pd.DataFrame({"place": np.arange(len(n)), "n": n.astype("int64")})

    asked = np.zeros(len(groups) + len(begins), "int64")
    # a row for each list and group, fewer than the centroids that were collected
    for place, n in probes.mapInPandas(count, "place bigint, n bigint").groupBy("place").agg(F.sum("n")).collect():
        asked[place] = n
    return asked[:len(groups)] > 0, asked[len(groups):]


def _look(rows: DataFrame, queries: DataFrame, probes: DataFrame, k: int, arrays: _Lists, block_rows: int) -> DataFrame:
    """The best rows of each query (query_id, vec and, if it has one, the ``least`` score wanted) in the lists that it probes."""
    count, most = len(arrays.ids), tiles.tile_rows(block_rows, arrays.centroids.shape[1])
    # neighbouring lists are searched together: a query is sent once to a group, not once to each list
    groups = vx.packed(arrays.rows, most)
    begins = np.flatnonzero(np.diff(groups, prepend=-1))
    ends = np.append(begins[1:], count)
    probed, asked = _asked(probes, groups)
    nb = np.maximum(1, np.ceil(np.bincount(groups, arrays.rows) / most)).astype(int)
    nq = tiles.blocks(asked, most, nb, rows.sparkSession.sparkContext.defaultParallelism)
    if not probed.all():  # of a stored index only the probed lists' folders are read
        rows = rows.where(F.col("list_id").isin([int(i) for i in arrays.ids[probed]]))
    plan = [(int(i), int(g), int(n - begins[g]), int(nb[g]), int(nq[g])) for n, (i, g) in enumerate(zip(arrays.ids, groups, strict=True))]
    plan = rows.sparkSession.createDataFrame(plan, "list_id int, grp int, place int, nb int, nq int")
    rows = rows.join(F.broadcast(plan), "list_id")  # one row a list, fewer than the centroids collected
    # an index has many small files: a task reads several
    tasks = max(2 * rows.sparkSession.sparkContext.defaultParallelism, int(arrays.rows.sum()) * arrays.centroids.shape[1] * 4 // TASK_BYTES)
    rows = rows.coalesce(tasks).select(F.col("grp").alias("list_id"), F.pmod(F.xxhash64("vec_id"), "nb").alias("blk"), F.col("nq").alias("n"), "vec_id",
                       F.col("embedding").alias("vec"), "place")
    # probes grow with the queries but lie in small files, so their size on disk must not choose a broadcast
    asking = queries.join(probes.drop("n").hint("merge"), "query_id")
    asking = asking.select("query_id", "vec", "lists", F.xxhash64("query_id").alias("h"), *(["least"] if "least" in queries.columns else []))

    def send(batches):
        for whole in batches:
            step = max(1, (1 << 24) // max(1, count))
            for batch in (whole.slice(i, step) for i in range(0, whole.num_rows, step)):
                ids, vecs = batch.column(0).to_numpy(), tiles.matrix(batch.column(1), "<f4")
                bits, h = _bits(batch.column(2).to_pylist(), count), batch.column(3).to_numpy()
                least = batch.column(4).to_numpy() if batch.num_columns > 4 else None
                for g, (begin, end) in enumerate(zip(begins, ends, strict=True)):
                    there = np.flatnonzero(bits[:, begin:end].any(axis=1))
                    block = h[there] % nq[g]
                    sent = ((block[x[0]], there[x]) for x in tiles.pieces(block))
                    yield tiles.packed_batch([(g, b, nb[g], ids[at].tobytes(), vecs[at].tobytes(), np.packbits(bits[at, begin:end], axis=1).tobytes(),
                                               None if least is None else least[at].tobytes()) for b, at in sent])

    best = tiles.tile_search(asking.mapInArrow(send, tiles.PACKED), tiles.pack(rows, "vec_id", "place"), k, ("<f4", "<f4"))
    return vx._final_topk(best, k)


def _lists_of(probes: DataFrame, ids: np.ndarray) -> DataFrame:
    def unpack(batches):
        for pdf in vx.in_parts(batches, len(ids)):
            at, column = np.nonzero(_bits(pdf["lists"], len(ids)))
            yield pd.DataFrame({"query_id": pdf["query_id"].to_numpy()[at], "list_id": ids[column].astype("int32")})

    return probes.select("query_id", "lists").mapInPandas(unpack, "query_id bigint, list_id int")


def search(spark: SparkSession, path: str, queries: DataFrame, k: int = 5, nprobe: int | None = None, query_id: str = "query_id",
           vec: str = "embedding", block_rows: int = 2000, upto: int | None = None) -> Found:
    """The ``k`` nearest stored rows of each query by cosine, ties by smaller id.

    Without ``nprobe`` the result is exact: every list that the angle bound can't rule out is looked into.
    """
    upto = version(spark, path) if upto is None else upto
    arrays = _collected(lists(spark, path, upto))
    known = spark.sparkContext.broadcast(arrays)
    asking, rows = spread_scan(_queries(queries, query_id, vec)), live_rows(spark, path, upto)
    first = nprobe or max(1, len(arrays.ids) // 20)
    probes = stored(_probes(asking, known, first), "probes")
    hits = _look(rows, asking, probes, k, arrays, block_rows)
    if nprobe:
        return Found(hits, _lists_of(probes, arrays.ids), probes.select("query_id", "n"))
    hits = stored(hits, "hits")
    # the k-th score so far; a query with fewer hits may not leave out any list
    last = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s"))
    last = last.where(F.col("n") >= k).select("query_id", F.least(F.greatest("s", F.lit(-1.0)), F.lit(1.0)).alias("s"))
    widened = asking.join(last, "query_id", "left").select("query_id", "vec", F.coalesce(F.acos("s"), F.lit(4.0)).alias("reach"),
                                                           F.coalesce("s", F.lit(-2.0)).alias("least"))
    more = stored(_probes(widened, known, first, beyond=True), "probes")
    beyond = _look(rows, widened.drop("reach"), more.where("n > 0"), k, arrays, block_rows)
    both = probes.unionByName(more)
    return Found(vx._final_topk(hits.drop("rank").unionByName(beyond.drop("rank")), k), _lists_of(both, arrays.ids), both.select("query_id", "n"))


def tune_probes(spark: SparkSession, path: str, queries: DataFrame, k: int = 5, recall: float = 0.95, sample: int = 256,
                query_id: str = "query_id", vec: str = "embedding") -> int:
    """The least ``nprobe`` that finds the ``recall`` share of the true neighbours of ``sample`` queries.

    The sample (by hash of the id) is searched exactly; each neighbour's list has a place in its query's probe order.
    """
    some = queries.orderBy(F.xxhash64(F.lit(17), query_id), query_id).limit(sample)
    some = stored(_queries(some, query_id, vec), "sample")
    true = search(spark, path, some, k, vec="vec").hits.select("query_id", "vec_id")
    known = spark.sparkContext.broadcast(_collected(lists(spark, path)))

    def places(batches):
        for pdf in vx.in_parts(batches, len(known.value.ids)):
            _, order = known.value.bounds(pdf["vec"])
            yield pd.DataFrame({"query_id": np.repeat(pdf["query_id"].to_numpy(), order.shape[1]),
                                "list_id": known.value.ids[order].ravel().astype("int32"),
                                "place": np.tile(np.arange(order.shape[1]), len(pdf))})

    placed = some.mapInPandas(places, "query_id bigint, list_id int, place bigint")
    where = live_rows(spark, path).select("vec_id", "list_id")
    found = true.join(where, "vec_id").join(placed, ["query_id", "list_id"]).groupBy("place").agg(F.count(F.lit(1)).alias("n"))
    share = F.sum("n").over(Window.orderBy("place")) / F.sum("n").over(Window.partitionBy())  # one row a list at most
    best = found.select("place", share.alias("share")).where(F.col("share") >= recall).agg(F.min("place")).first()[0]
    return 1 if best is None else int(best) + 1


def probed_share(found: Found, queries: DataFrame, num_lists: int) -> DataFrame:
    """Share of all (query, list) pairs that a search looked into."""
    asked = queries.agg(F.count(F.lit(1)).alias("q"))
    return found.looked.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("p")).crossJoin(asked).select(
        F.when(F.col("q") > 0, F.col("p") / (F.col("q") * num_lists)).alias("lists_read"))

"""Embeddings and vector search: exact cosine top-k, IVF lists (k-means), IVF-pruned search,
index coverage, exact similarity joins and MinHash near-duplicate candidates.

Scale rules followed here:
* the query set is broadcast only after its size is checked (``MAX_BROADCAST_QUERIES``, more is an
  error); ``blocked=True`` takes any number through the blocked kernel below, which is exact too;
* every scoring group holds a bounded number of base rows and of query rows (a tile, see :mod:`tiles`):
  a hot IVF list (or a huge base) is split into hash blocks, and each query meets every
  block of its lists once — partial top-k per block, final top-k per query;
* scoring is numpy matrix products inside Arrow batches (``mapInPandas`` /
  ``cogroup().applyInArrow``); only k rows per query per block leave a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import HashingTF, IDF, Normalizer, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeloom.operators import tiles
from lakeloom.operators.marts import top_k_per
from lakeloom.session import cut_lineage, spread
from lakeloom.sources.sinks import rebalanced

HIT_SCHEMA = "query_id bigint, vec_id bigint, score double"
MAX_BROADCAST_QUERIES = 4096
#: Rows (list id and two counts) of a plan that is broadcast; a longer one is joined.
MAX_BROADCAST_LISTS = 1_000_000
#: Blocks of rows that the similarity join sends to a task together; they are scored in parts.
GROUP_BLOCKS = 4
#: Bytes of centroids that are broadcast.
MAX_CENTROID_BYTES = 64 << 20


def _matrix(series: pd.Series) -> np.ndarray:
    m = np.stack([np.asarray(v, dtype=np.float64) for v in series]) if len(series) else np.zeros((0, 0))
    if m.size:
        n = np.linalg.norm(m, axis=1, keepdims=True)
        n[n == 0] = np.nan
        m = m / n
    return m


def packed(sizes: Sequence[int], most: int) -> np.ndarray:
    """A group number for each of several lists, in their order: neighbours share a group of ``most`` rows, a longer list has its own."""
    groups, held = np.zeros(len(sizes), dtype="int64"), 0
    for i, n in enumerate(sizes):
        groups[i] = groups[i - 1] if i else 0
        if held and held + n > most:
            groups[i], held = groups[i] + 1, 0
        held += int(n)
    return groups


def in_parts(batches: Iterator[pd.DataFrame], width: int, values: int = 1 << 20) -> Iterator[pd.DataFrame]:
    """The batches cut so that a matrix with ``width`` columns and a row for each of theirs stays small."""
    step = max(1, values // max(1, width))
    for pdf in batches:
        for i in range(0, len(pdf), step):
            yield pdf.iloc[i:i + step].reset_index(drop=True)


def _topk_block(qids: np.ndarray, Q: np.ndarray, bids: np.ndarray, B: np.ndarray, k: int, decimals: int | None = None) -> pd.DataFrame:
    """Exact top-k of base rows for each query in one block; ties (of scores rounded to ``decimals``, if given) broken by smaller id."""
    if len(qids) == 0 or len(bids) == 0:
        return pd.DataFrame({"query_id": pd.Series([], dtype="int64"), "vec_id": pd.Series([], dtype="int64"),
                             "score": pd.Series([], dtype="float64")})
    S = np.nan_to_num(Q @ B.T, nan=-np.inf)  # (nq, nb)
    if decimals is not None:
        S = np.round(S, decimals)
    kk = min(k, len(bids))
    out_q, out_b, out_s = [], [], []
    for j in range(len(qids)):
        row = S[j]
        if kk < len(row):
            t = np.partition(row, len(row) - kk)[len(row) - kk]
            cand = np.nonzero(row >= t)[0]
        else:
            cand = np.arange(len(row))
        order = cand[np.lexsort((bids[cand], -row[cand]))][:kk]
        out_q.append(np.full(len(order), qids[j]))
        out_b.append(bids[order])
        out_s.append(row[order])
    return pd.DataFrame({"query_id": np.concatenate(out_q).astype("int64"),
                         "vec_id": np.concatenate(out_b).astype("int64"),
                         "score": np.concatenate(out_s).astype("float64")})


def _final_topk(partials: DataFrame, k: int) -> DataFrame:
    return top_k_per(partials.filter(F.col("score") > float("-inf")), ["query_id"],
                     [F.col("score").desc(), F.col("vec_id").asc()], k, rank_col="rank")


def vector_search(base: DataFrame, queries: DataFrame, k: int = 5, base_id: str = "vec_id", base_vec: str = "embedding",
                  query_id: str = "query_id", query_vec: str = "embedding", blocked: bool = False,
                  block_rows: int = 2000, decimals: int | None = None) -> DataFrame:
    """Exact cosine top-k base rows per query: ``(query_id, vec_id, score, rank)``.

    By default the queries are few and are broadcast (at most ``MAX_BROADCAST_QUERIES``; more is an
    error); ``blocked=True`` is for query tables of any size and scores blocks against blocks. With ``decimals``
    scores are rounded before they are ranked, so that vectors alike but for rounding errors rank by id.
    """
    b = base.select(F.col(base_id).cast("bigint").alias("vec_id"), F.col(base_vec).alias("vec"))
    q = queries.select(F.col(query_id).cast("bigint").alias("query_id"), F.col(query_vec).alias("vec"))
    if blocked:
        return blocked_search(q.withColumn("list_id", F.lit(0)), b.withColumn("list_id", F.lit(0)), k, block_rows, decimals)
    qpdf = q.limit(MAX_BROADCAST_QUERIES + 1).toPandas()
    if len(qpdf) > MAX_BROADCAST_QUERIES:
        raise ValueError(f"more than {MAX_BROADCAST_QUERIES} queries to broadcast; search with blocked=True")
    spark = base.sparkSession
    bq = spark.sparkContext.broadcast((qpdf["query_id"].to_numpy(dtype="int64"), _matrix(qpdf["vec"])))

    def kernel(batches):
        qids, Q = bq.value
        for pdf in batches:
            yield _topk_block(qids, Q, pdf["vec_id"].to_numpy(dtype="int64"), _matrix(pdf["vec"]), k, decimals)

    return _final_topk(b.mapInPandas(kernel, HIT_SCHEMA), k)


def _blocked_groups(q: DataFrame, b: DataFrame, block_rows: int, of_q: Sequence[str] = (),
                    of_b: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, list[str]]:
    """Cut each list into ``ceil(rows / block_rows)`` hash blocks on both sides and replicate
    a query row to every base block of its list (and vice versa): every (query, base) pair of
    a list meets in exactly one group, and no group exceeds ``block_rows`` rows per side.
    The columns ``of_q`` and ``of_b`` go along."""
    def chunks(df, alias):
        sizes = df.groupBy("list_id").agg(F.count(F.lit(1)).alias("n"))
        return sizes.select("list_id", F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(block_rows))).cast("int").alias(alias))

    plan = chunks(b, "nb").join(chunks(q, "nq"), "list_id")  # one row per list
    # one row per list: broadcast when the list count is within bounds, else a normal join
    plan = F.broadcast(plan) if plan.count() <= MAX_BROADCAST_LISTS else plan
    bb = (b.join(plan, "list_id")
           .withColumn("bblk", F.pmod(F.xxhash64("vec_id"), F.col("nb")).cast("int"))
           .withColumn("qblk", F.explode(F.sequence(F.lit(0), F.col("nq") - 1)))
           .select("list_id", "bblk", "qblk", "vec_id", "vec", *of_b))
    qq = (q.join(plan, "list_id")
           .withColumn("qblk", F.pmod(F.xxhash64("query_id"), F.col("nq")).cast("int"))
           .withColumn("bblk", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
           .select("list_id", "bblk", "qblk", "query_id", F.col("vec").alias("qvec"), *of_q))
    return qq, bb, ["list_id", "bblk", "qblk"]


def blocked_search(q: DataFrame, b: DataFrame, k: int, block_rows: int = 2000, decimals: int | None = None) -> DataFrame:
    """Exact top-k of ``b`` rows for each ``q`` row within the same ``list_id``, scored in tiles (see :mod:`tiles`): a list's
    rows are cut into hash blocks on both sides, and each block of queries meets each block of rows once; partial top-k per
    tile, final per query. A block has ``tiles.TILE_BLOCKS * block_rows`` rows, fewer if vectors are long.
    """
    sizes = lambda df: df.groupBy("list_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dims"))
    kinds = tiles.kind(q), tiles.kind(b)
    most = [F.greatest(F.lit(1), F.least(F.lit(tiles.TILE_BLOCKS * block_rows), F.floor(F.lit(tiles.TILE_BYTES // int(x[-1])) / F.greatest(F.lit(1), "dims")))) for x in kinds]
    plan = sizes(b).select("list_id", F.ceil(F.col("n") / most[1]).cast("int").alias("nb")).join(
        sizes(q).select("list_id", "n", F.ceil(F.col("n") / most[0]).cast("int").alias("nq")), "list_id")  # one row a list
    lists, pairs = plan.agg(F.count(F.lit(1)), F.sum(F.col("nb") * F.col("nq"))).first()
    # few queries a block if that makes tiles for all tasks
    more = max(1, math.ceil(2 * q.sparkSession.sparkContext.defaultParallelism / max(1, pairs or 0)))
    plan = plan.withColumn("nq", F.greatest("nq", F.least(F.col("nq") * more, F.floor(F.col("n") / tiles.CHUNK_QUERIES))).cast("int")).drop("n")
    # broadcast when the list count is within bounds, else a normal join
    plan = F.broadcast(plan) if lists <= MAX_BROADCAST_LISTS else plan
    block = lambda row_id, n: F.pmod(F.xxhash64(row_id), F.col(n)).cast("int").alias("blk")
    qq = q.join(plan, "list_id").select("list_id", block("query_id", "nq"), F.col("nb").alias("n"), "query_id", "vec")
    bb = b.join(plan, "list_id").select("list_id", block("vec_id", "nb"), F.col("nq").alias("n"), "vec_id", "vec")
    return _final_topk(tiles.tile_search(tiles.pack(qq, "query_id"), tiles.pack(bb, "vec_id"), k, kinds, decimals), k)


def label_centroids(df: DataFrame, label: str = "label", vec: str = "embedding", dims: int | None = None) -> DataFrame:
    """Mean vector per label (the query set of the exact search): one aggregate per
    (label, dimension), re-assembled in dimension order. Output ``(query_id, embedding)``."""
    per_dim = (df.select(F.col(label).cast("bigint").alias("query_id"), F.posexplode(vec).alias("pos", "x"))
                 .groupBy("query_id", "pos").agg(F.avg("x").alias("x")))
    return (per_dim.groupBy("query_id")
                   .agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("p"))
                   .select("query_id", F.transform("p", lambda s: s["x"]).alias("embedding")))


# --- IVF -------------------------------------------------------------------------------------------

def build_ivf(base: DataFrame, num_lists: int = 500, seed: int = 42, id_col: str = "vec_id", vec: str = "embedding",
              max_iter: int = 20) -> tuple[DataFrame, DataFrame]:
    """IVF index: k-means (cosine) centroids and each base row's list.

    Returns ``(assignments(vec_id, list_id, embedding), centroids(list_id, centroid))``.
    k-means needs at least one row per list: more lists than rows is an error.
    """
    feats = base.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec).alias("embedding"),
                        array_to_vector(F.col(vec)).alias("features"))
    if feats.limit(num_lists).count() < num_lists:
        raise ValueError(f"fewer rows than the {num_lists} lists asked for")
    model = KMeans(k=num_lists, seed=seed, maxIter=max_iter, distanceMeasure="cosine", featuresCol="features",
                   predictionCol="list_id").fit(feats)
    assigned = model.transform(feats).select("vec_id", F.col("list_id").cast("int").alias("list_id"), "embedding")
    spark = base.sparkSession
    centers = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]  # k × dims, bounded by k
    centroids = spark.createDataFrame(centers, "list_id int, centroid array<double>")
    return assigned, centroids


def store_ivf(assigned: DataFrame, centroids: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Write an index once, its rows partitioned by list, and read it back: a search then opens the probed lists only."""
    rebalanced(assigned, "list_id").write.mode("overwrite").option("partitionOverwriteMode", "static") \
        .partitionBy("list_id").parquet(f"{path}/rows")
    centroids.write.mode("overwrite").parquet(f"{path}/centroids")
    spark = assigned.sparkSession
    return spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/centroids")


def probe_lists(queries: DataFrame, centroids: DataFrame, nprobe: int, query_id: str = "query_id",
                vec: str = "embedding") -> DataFrame:
    """The ``nprobe`` nearest lists of each query: ``(query_id, list_id)``.

    The centroid table has one row per list and is broadcast after a check of its bytes.
    """
    size = centroids.agg(F.sum(8 * F.size("centroid"))).first()[0] or 0
    if size > MAX_CENTROID_BYTES:
        raise ValueError(f"{size} bytes of centroids are too many to broadcast; build fewer lists")
    cpdf = centroids.orderBy("list_id").toPandas()  # num_lists rows, checked above
    spark = queries.sparkSession
    bc = spark.sparkContext.broadcast((cpdf["list_id"].to_numpy(dtype="int64"), _matrix(cpdf["centroid"])))

    def kernel(batches):
        lids, C = bc.value
        for pdf in batches:
            Q = _matrix(pdf["vec"])
            res = _topk_block(pdf["query_id"].to_numpy(dtype="int64"), Q, lids, C, nprobe)
            yield res.rename(columns={"vec_id": "list_id"})[["query_id", "list_id"]]

    q = queries.select(F.col(query_id).cast("bigint").alias("query_id"), F.col(vec).alias("vec"))
    return q.mapInPandas(kernel, "query_id bigint, list_id bigint").withColumn("list_id", F.col("list_id").cast("int"))


def vector_search_ivf(assigned: DataFrame, centroids: DataFrame, queries: DataFrame, k: int = 5,
                      fraction: float = 0.01, query_id: str = "query_id", vec: str = "embedding",
                      block_rows: int = 2000) -> DataFrame:
    """Search only the ``ceil(fraction · lists)`` nearest lists of each query (exact inside
    them): an equi-join on ``list_id`` instead of a scan of every base row."""
    num_lists = centroids.count()
    nprobe = max(1, math.ceil(fraction * num_lists))
    probes = probe_lists(queries, centroids, nprobe, query_id, vec)
    q = (queries.select(F.col(query_id).cast("bigint").alias("query_id"), F.col(vec).alias("vec"))
                .join(probes, "query_id"))
    b = assigned.select("vec_id", "list_id", F.col("embedding").alias("vec"))
    # of a stored index only the probed lists' folders are read (dynamic partition pruning)
    b = b.join(F.broadcast(probes.select("list_id").distinct()), "list_id", "left_semi")
    return blocked_search(q, b, k, block_rows)


def index_status(base: DataFrame, assigned: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """Coverage of an index: base rows, indexed base rows (semi-join), and their ratio."""
    ids = base.select(F.col(id_col).cast("bigint").alias("vec_id"))
    indexed = ids.join(assigned.select("vec_id"), "vec_id", "left_semi")
    tagged = ids.select(F.lit(1).alias("b"), F.lit(0).alias("i")).unionByName(
        indexed.select(F.lit(0).alias("b"), F.lit(1).alias("i")))
    out = tagged.agg(F.sum("b").cast("bigint").alias("base_rows"), F.sum("i").cast("bigint").alias("indexed_rows"))
    return out.withColumn("coverage", F.when(F.col("base_rows") > 0, F.col("indexed_rows") / F.col("base_rows")))


def recall_at_k(approx: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact neighbours that the approximate search also returned."""
    # sorted, not broadcast: hits stored by one query after the other are far smaller on disk than in memory
    hit = exact.join(approx.select("query_id", "vec_id").hint("merge"), ["query_id", "vec_id"], "left_semi")
    tagged = exact.select(F.lit(1).alias("e"), F.lit(0).alias("h")).unionByName(
        hit.select(F.lit(0).alias("e"), F.lit(1).alias("h")))
    return tagged.agg((F.sum("h") / F.sum("e")).alias("recall"))


# --- similarity joins ------------------------------------------------------------------------------

def similar_pairs(df: DataFrame, id_col: str = "vec_id", vec: str = "embedding", max_dist: float = 0.5,
                  block_rows: int = 2000) -> DataFrame:
    """All pairs with cosine distance ``<= max_dist`` — exact, as a blocked self-join.

    Rows are hashed into ``nb`` blocks; block pair (a, b) with a <= b is one group that
    holds at most ``2 · block_rows`` rows, so no group is unbounded however the data is
    skewed. Output ``(id_a, id_b, similarity)`` with ``id_a < id_b``.
    """
    src = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec).alias("vec"))
    n = src.count()
    nb = max(1, math.ceil(n / block_rows))
    blk = F.pmod(F.xxhash64("id"), F.lit(nb)).cast("int")
    left = (src.withColumn("a", blk).withColumn("b", F.explode(F.sequence(F.col("a"), F.lit(nb - 1))))
               .select("a", "b", "id", "vec"))
    # the right side gets its own column names: a cogroup of two frames derived from the same
    # source with identical attributes would otherwise see only the key columns on one side
    right = (src.withColumn("b", blk).withColumn("a", F.explode(F.sequence(F.lit(0), F.col("b"))))
                .select("a", "b", F.col("id").alias("rid"), F.col("vec").alias("rvec")))
    min_sim = 1.0 - max_dist

    def kernel(lp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
        if len(lp) == 0 or len(rp) == 0:
            return pd.DataFrame({"id_a": pd.Series([], dtype="int64"), "id_b": pd.Series([], dtype="int64"),
                                 "similarity": pd.Series([], dtype="float64")})
        li = lp["id"].to_numpy(dtype="int64")
        ri = rp["rid"].to_numpy(dtype="int64")
        S = _matrix(lp["vec"]) @ _matrix(rp["rvec"]).T
        ii, jj = np.nonzero(np.nan_to_num(S, nan=-2.0) >= min_sim)
        if int(lp["a"].iloc[0]) == int(rp["b"].iloc[0]):
            keep = li[ii] < ri[jj]  # diagonal block: each unordered pair once
            ii, jj = ii[keep], jj[keep]
        lo, hi = np.minimum(li[ii], ri[jj]), np.maximum(li[ii], ri[jj])
        return pd.DataFrame({"id_a": lo, "id_b": hi, "similarity": S[ii, jj]})

    return left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInPandas(
        kernel, "id_a bigint, id_b bigint, similarity double")


def similar_pairs_ivf(assigned: DataFrame, centroids: DataFrame, max_dist: float = 0.5, nprobe: int = 2,
                      block_rows: int = 2000) -> DataFrame:
    """Similarity join pruned by an IVF index, for tables too large for all pairs.

    Every row visits its ``nprobe`` nearest lists and is compared with the rows living there,
    in the same bounded blocks as :func:`blocked_search`; a pair is found when either row's
    probes reach the other's list. Pairs split across non-probed lists are missed (probe all
    lists to get :func:`similar_pairs` exactly). Output ``(id_a, id_b, similarity)``.
    """
    queries = assigned.select(F.col("vec_id").alias("query_id"), "embedding")
    probes = probe_lists(queries, centroids, nprobe)
    q = queries.join(probes, "query_id").select("query_id", "list_id", F.col("embedding").alias("vec"))
    b = assigned.select("vec_id", "list_id", F.col("embedding").alias("vec"))
    qq, bb, keys = _blocked_groups(q, b, block_rows)
    min_sim = 1.0 - max_dist
    schema = "id_a bigint, id_b bigint, similarity double"

    def kernel(qpdf: pd.DataFrame, bpdf: pd.DataFrame) -> pd.DataFrame:
        if len(qpdf) == 0 or len(bpdf) == 0:
            return pd.DataFrame({"id_a": pd.Series([], dtype="int64"), "id_b": pd.Series([], dtype="int64"),
                                 "similarity": pd.Series([], dtype="float64")})
        qi = qpdf["query_id"].to_numpy(dtype="int64")
        bi = bpdf["vec_id"].to_numpy(dtype="int64")
        S = _matrix(qpdf["qvec"]) @ _matrix(bpdf["vec"]).T
        ii, jj = np.nonzero(np.nan_to_num(S, nan=-2.0) >= min_sim)
        keep = qi[ii] != bi[jj]
        ii, jj = ii[keep], jj[keep]
        return pd.DataFrame({"id_a": np.minimum(qi[ii], bi[jj]), "id_b": np.maximum(qi[ii], bi[jj]),
                             "similarity": S[ii, jj]})

    pairs = qq.groupBy(*keys).cogroup(bb.groupBy(*keys)).applyInPandas(kernel, schema)
    # a pair reached from both sides appears twice: keep one (bounded by the output size)
    return pairs.groupBy("id_a", "id_b").agg(F.max("similarity").alias("similarity"))


# --- text embeddings and near duplicates ---------------------------------------------------------------

def embed(df: DataFrame, text_col: str = "text", dims: int = 256, id_col: str = "doc_id") -> DataFrame:
    """Text → L2-normalised TF-IDF vector (hashing trick) as ``array<float>``, with a status.

    Stands in for a remote embedding model: same contract (content, embedding, status) and
    rows with a non-empty status are dropped. The IDF fit is one distributed aggregation.
    """
    tok = RegexTokenizer(inputCol=text_col, outputCol="__tokens", pattern=r"\W+", toLowercase=True)
    tf = HashingTF(inputCol="__tokens", outputCol="__tf", numFeatures=dims)
    words = tf.transform(tok.transform(spread(df.select(id_col, text_col))))
    idf = IDF(inputCol="__tf", outputCol="__tfidf").fit(words)
    out = Normalizer(inputCol="__tfidf", outputCol="__unit", p=2.0).transform(idf.transform(words))
    out = out.select(id_col, F.col(text_col).alias("content"),
                     vector_to_array("__unit", "float32").alias("embedding"),
                     F.when(F.size("__tokens") == 0, F.lit("EMPTY_TEXT")).otherwise(F.lit("")).alias("status"))
    return out.filter(F.col("status") == "")


def _signer(shingle: int, num_hashes: int, seed: int = 42):
    """Arrow function: (id, per-word hashes computed in the JVM) → (id, distinct shingle hashes, MinHash signature).

    Per row it is a small numpy helper: combine ``shingle`` consecutive word hashes into one
    shingle hash, then ``num_hashes`` universal hash permutations as one min-reduction.
    """
    rng = np.random.default_rng(seed)
    a = rng.integers(1, 2**63 - 1, size=num_hashes, dtype=np.uint64) | np.uint64(1)
    b = rng.integers(0, 2**63 - 1, size=num_hashes, dtype=np.uint64)
    # odd multipliers that combine the hashes of ``shingle`` consecutive words into one
    mult = rng.integers(1, 2**63 - 1, size=shingle, dtype=np.uint64) | np.uint64(1)
    no_shingles = np.zeros(0, dtype=np.int64)
    no_sig = np.zeros(num_hashes, dtype=np.int64)

    def one(wh):
        if not len(wh):
            return no_shingles, no_sig
        n = max(1, len(wh) - shingle + 1)
        g = np.zeros(n, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for j in range(min(shingle, len(wh))):
                g += wh[j:j + n] * mult[j]
            h = np.unique(g)
            perm = a[:, None] * h[None, :]
            perm += b[:, None]
        return h.view(np.int64), perm.min(axis=1).view(np.int64)

    def lists(parts):
        ends = np.cumsum([0, *map(len, parts)])
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate([no_shingles, *parts])))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(1)
            ends, flat = words.offsets.to_numpy(), words.values.to_numpy(zero_copy_only=False).view(np.uint64)
            rows = [one(flat[x:y]) for x, y in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.record_batch([batch.column(0), lists([r[0] for r in rows]), lists([r[1] for r in rows])], ["id", "shingles", "sig"])

    return sign


def minhash_signatures(df: DataFrame, id_col: str, text_col: str, shingle: int = 5, num_hashes: int = 64,
                       partitions: int | None = None) -> DataFrame:
    """Word-shingle MinHash signatures over the whole text: ``(id, shingles, sig)``.

    Tokenising and word hashing are JVM expressions (``split`` + ``transform(xxhash64)``);
    only the shingle combination and the min-hash run in Python, on Arrow batches, once a row. ``partitions`` deals the texts
    to that many tasks first (see ``session.spread``).
    """
    src = spread(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), partitions)
    words = F.filter(F.split(F.lower(F.col("text")), r"[^\p{L}\p{N}_]+"), lambda w: w != "")
    hashes = F.coalesce(F.transform(words, lambda w: F.xxhash64(w)), F.array().cast("array<bigint>"))
    schema = StructType([src.schema["id"], *StructType.fromDDL("shingles array<bigint>, sig array<bigint>").fields])
    return src.select("id", hashes.alias("wh")).mapInArrow(_signer(shingle, num_hashes), schema)


def dedupe_candidates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8,
                      bands: int = 16, rows_per_band: int = 4, shingle: int = 5) -> DataFrame:
    """Near-duplicate candidates for review: ``(id, rep_id, jaccard)`` with ``id > rep_id``.

    LSH banding on MinHash signatures; inside a bucket every member is linked to the
    bucket's smallest id (a star — linear in the bucket size, never all pairs), then each
    link is verified with the exact shingle Jaccard similarity.
    """
    # signatures feed the banding and both sides of the verification join: materialise them
    # once (reliable checkpoint in the shared folder) instead of re-running the text UDF 3×
    sigs = cut_lineage(minhash_signatures(df, id_col, text_col, shingle, bands * rows_per_band))
    buckets = sigs.select("id", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)),
                                                          lambda b: F.xxhash64(F.slice("sig", b * rows_per_band + 1, rows_per_band)))
                                              ).alias("band", "bucket"))
    reps = buckets.groupBy("band", "bucket").agg(F.min("id").alias("rep_id"))
    edges = (buckets.join(reps, ["band", "bucket"]).filter(F.col("id") != F.col("rep_id"))
                    .select("id", "rep_id").distinct())
    s = sigs.select("id", "shingles")
    r = sigs.select(F.col("id").alias("rep_id"), F.col("shingles").alias("rep_shingles"))
    j = edges.join(s, "id").join(r, "rep_id")
    inter = F.size(F.array_intersect("shingles", "rep_shingles"))
    union = F.size(F.array_union("shingles", "rep_shingles"))
    return (j.select("id", "rep_id", F.when(union > 0, inter / union).otherwise(F.lit(1.0)).alias("jaccard"))
             .filter(F.col("jaccard") >= threshold))

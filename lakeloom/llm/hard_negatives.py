"""Hard-negative mining by a secondary-sort shuffle.

Every anchor is scored against every row, in blocks. A pair's score travels as one packed key: anchor, descending
score, kind (positives first) and id, each as big-endian bytes, so that the bytes sort as the values do. Keys are dealt by
their anchor and sorted within partitions; a streaming iterator walks down the scores, opens a window at each
positive and emits the negatives that fall into it. It holds one anchor's open windows (``positives`` at most), never its rows.

Blocks are reduced before the shuffle, without loss. The first pass sends each block's best ``positives`` rows of
the anchor's label; the best of all blocks are the anchor's positives. The second pass knows their windows and sends
of each block the first ``negatives`` rows in each of them: no later one can be among the first of all blocks.
The blocks of rows are cut by position, so a repeated id or a hot label fills no block; anchors are cut by hash.

Scores are integer inner products. While they are sure to stay below 2^53 they come from one float matrix product, which
is exact there, else from Python's integers; a score beyond 64 bits is an error.

Defined results: rows with a null id, label or vector, or a null or non-finite component take no part. A vector shorter than
another is read as filled up with zeros. Of anchor rows that share an id the one with the least label and vector asks;
rows with the anchor's id are no positives of it. Repeated rows count each; equal scores rank by smaller id. Anchors without
positives, and positives whose window holds no row, give no row. Extra columns aren't read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.llm.common import stored

#: Rows and anchors of a block: 8192 vectors of 64 doubles are 4 MB.
BLOCK_ROWS = 8192
#: Scores looked at at once.
SLICE_CELLS = 1 << 20
#: Bytes of a packed key: anchor, score and id of eight each, and the kind.
KEY = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")])
POSITIVE, NEGATIVE = 0, 1
SIGN = np.uint64(1 << 63)
PAIR_SCHEMA = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
PAIR_ARROW = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()), ("negative_id", pa.int64()),
                        ("positive_score", pa.int64()), ("negative_score", pa.int64())])
KEY_ARROW = pa.schema([("key", pa.binary())])


# --- packed keys ---------------------------------------------------------------------------------------------------

def pack(anchor: np.ndarray, score: np.ndarray, kind: int, ids: np.ndarray) -> pa.RecordBatch:
    """One binary key a pair; its bytes sort by anchor, descending score, kind and id."""
    out = np.empty(len(ids), KEY)
    out["anchor"] = anchor.astype(np.int64).view(np.uint64) ^ SIGN
    out["score"] = ~(score.astype(np.int64).view(np.uint64) ^ SIGN)
    out["kind"] = kind
    out["id"] = ids.astype(np.int64).view(np.uint64) ^ SIGN
    fixed = pa.Array.from_buffers(pa.binary(KEY.itemsize), len(out), [None, pa.py_buffer(out.tobytes())])
    return pa.RecordBatch.from_arrays([fixed.cast(pa.binary())], schema=KEY_ARROW)


def unpack(keys: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors, scores, kinds and ids of packed keys."""
    raw = np.frombuffer(b"".join(keys.to_pylist()), KEY)
    anchor, score, ids = (raw[c].astype(np.uint64) for c in ("anchor", "score", "id"))
    return (anchor ^ SIGN).view(np.int64), (~score ^ SIGN).view(np.int64), raw["kind"], (ids ^ SIGN).view(np.int64)


# --- scores of a block ---------------------------------------------------------------------------------------------

def _vectors(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Rows of ``dims`` doubles, shorter vectors filled up with zeros."""
    column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims))
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of ``a`` and ``b``."""
    if not a.shape[1]:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1] < float(1 << 53):
        return (a @ b.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape)
    return (whole(a) @ whole(b).T).astype(np.int64)


def _slices(anchors: pa.Table, rows: pa.Table) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """``(slice of the anchors, scores, same label, ids of the rows)``; the rows' columns are in order of their ids."""
    vectors = [anchors.column("a_vec"), rows.column("vec")]
    dims = max(int(c.combine_chunks().value_lengths().to_numpy(zero_copy_only=False).max(initial=0)) for c in vectors)
    ids = rows.column("id").to_numpy()
    order = np.argsort(ids, kind="stable")
    ids, labels, base = ids[order], rows.column("label").to_numpy()[order], _vectors(vectors[1], dims)[order]
    own, own_labels = _vectors(vectors[0], dims), anchors.column("a_label").to_numpy()
    step = max(1, SLICE_CELLS // max(1, len(ids)))
    for at in range(0, len(own), step):
        part = slice(at, at + step)
        yield part, _scores(own[part], base), own_labels[part, None] == labels[None, :], ids


def _first(at: np.ndarray, most: int) -> np.ndarray:
    """Of entries grouped by ``at`` (ascending), whether each is among the first ``most`` of its group."""
    return np.arange(len(at)) - np.searchsorted(at, at) < most


def _ranked(wanted: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, column and score of the wanted cells, by anchor, descending score and id."""
    at, column = np.nonzero(wanted)
    score = scores[at, column]
    order = np.lexsort((column, ~score, at))  # ~x falls as x rises
    return at[order], column[order], score[order]


def _best_same(anchors: pa.Table, rows: pa.Table, most: int) -> Iterator[pa.RecordBatch]:
    """Keys of the block's first ``most`` other rows of each anchor's label."""
    asks = anchors.column("a_id").to_numpy()
    for part, scores, same, ids in _slices(anchors, rows):
        wanted = same & (ids[None, :] != asks[part, None])
        if len(ids) > most:
            own = np.where(wanted, scores, np.iinfo(np.int64).min)
            wanted &= own >= np.partition(own, -most, axis=1)[:, -most, None]
        at, column, score = _ranked(wanted, scores)
        keep = _first(at, most)
        yield pack(asks[part][at[keep]], score[keep], POSITIVE, ids[column[keep]])


def _in_windows(anchors: pa.Table, rows: pa.Table, most: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    """Keys of the block's first ``most`` rows of other labels in each window of each anchor."""
    asks, found = anchors.column("a_id").to_numpy(), anchors.column("scores").to_pylist()
    far = np.iinfo(np.int64)
    # bounds of the windows, rounded inwards; one that holds no number lies beyond all scores
    spans = [[(-(-low * p // 100), high * p // 100) for p in own] for own in found]
    spans = [[x for x in own if x[0] <= x[1]] for own in spans]
    count = max(map(len, spans), default=0)
    lows, highs = (np.array([[x[k] for x in own] + [empty] * (count - len(own)) for own in spans], np.int64).reshape(len(spans), count)
                   for k, empty in ((0, far.max), (1, far.min)))
    for part, scores, same, ids in _slices(anchors, rows):
        lo, hi = lows[part], highs[part]
        wanted = ~same & (scores >= lo.min(axis=1, initial=far.max)[:, None]) & (scores <= hi.max(axis=1, initial=far.min)[:, None])
        at, column, score = _ranked(wanted, scores)
        keep = np.zeros(len(at), bool)
        for w in range(count):
            inside = np.flatnonzero((score >= lo[at, w]) & (score <= hi[at, w]))
            keep[inside[_first(at[inside], most)]] = True
        yield pack(asks[part][at[keep]], score[keep], NEGATIVE, ids[column[keep]])


# --- the secondary sort --------------------------------------------------------------------------------------------

def _mined(batches: Iterator[pa.RecordBatch], most: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    """Sorted keys → pairs: positives open windows, negatives that fall into open windows leave at once."""
    now, windows = None, []
    for batch in batches:
        out = []
        for anchor, score, kind, row in zip(*(c.tolist() for c in unpack(batch.column(0))), strict=True):
            if anchor != now:
                now, windows = anchor, []
            if kind == POSITIVE:
                windows.append([row, score, 0])
                continue
            for w in windows:
                if w[2] < most and low * w[1] <= 100 * score <= high * w[1]:
                    w[2] += 1
                    out.append((anchor, w[0], w[2], row, w[1], score))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out, strict=True), PAIR_ARROW, strict=True)],
                                             schema=PAIR_ARROW)


def _scores_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        anchor, score, _, _ = unpack(batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(score)], names=["a_id", "score"])


def _anchor_of(key: str = "key") -> Column:
    return F.substring(key, 1, 8)


def rows_of(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256, swap_every: int = 7,
            labels: int = 10) -> DataFrame:
    """``id, label, vec`` of the rows that take part: components become floor(scale * x), every ``swap_every``-th id the next label."""
    whole = lambda y: F.when(F.abs(y) < float(1 << 53), F.floor(y).cast("double")).otherwise(y)  # noqa: E731  larger ones are whole already
    x = df.select(F.col(key).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), F.col(vector).cast("array<double>").alias("vec"))
    x = x.where("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL")
    x = x.where(F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))))
    swapped = F.when(F.col("id") % swap_every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return x.select("id", swapped.alias("label"), F.transform("vec", lambda v: whole(v * scale)).alias("vec"))


def mine(df: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, anchor_every: int = 50,
         block_rows: int = BLOCK_ROWS, **columns) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of each anchor's hard negatives.

    A negative's score lies between ``low`` and ``high`` percent of its positive's.
    """
    # written once, so that a row's position, which decides its block, holds in every pass
    rows = stored(rows_of(df, **columns), "vectors")
    anchors = rows.where(F.col("id") % anchor_every == 0).groupBy("id").agg(F.min(F.struct("label", "vec")).alias("x"))
    anchors = stored(anchors.select(F.col("id").alias("a_id"), F.col("x.label").alias("a_label"), F.col("x.vec").alias("a_vec")), "anchors")
    base_blocks = max(1, math.ceil(rows.count() / block_rows))
    anchor_blocks = max(1, math.ceil(anchors.count() / block_rows))
    dealt = rows.withColumn("b", F.pmod(F.monotonically_increasing_id(), F.lit(base_blocks)))
    dealt = dealt.withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1)).cast("array<bigint>"))).groupBy("a", "b")

    def scored(asking: DataFrame, block) -> DataFrame:
        x = asking.withColumn("a", F.pmod(F.xxhash64("a_id"), F.lit(anchor_blocks)))
        x = x.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(base_blocks - 1)).cast("array<bigint>")))

        def one(left: pa.Table, right: pa.Table) -> pa.Table:
            parts = block(left, right) if left.num_rows and right.num_rows else ()
            return pa.Table.from_batches(parts, KEY_ARROW)

        return x.groupBy("a", "b").cogroup(dealt).applyInArrow(one, "key binary")

    best = scored(anchors, lambda left, right: _best_same(left, right, positives))
    place = F.row_number().over(Window.partitionBy(_anchor_of()).orderBy("key"))
    best = stored(best.withColumn("place", place).where(F.col("place") <= positives).select("key"), "positives")
    scores = best.mapInArrow(_scores_of, "a_id bigint, score bigint").groupBy("a_id").agg(F.collect_list("score").alias("scores"))
    near = scored(anchors.join(scores, "a_id"), lambda left, right: _in_windows(left, right, negatives, low, high))
    keys = best.unionByName(near).repartition(_anchor_of()).sortWithinPartitions("key")
    return keys.mapInArrow(lambda batches: _mined(batches, negatives, low, high), PAIR_SCHEMA)


#: DuckDB SQL for :func:`mine` with its defaults over ``embeddings``.
ORACLE = """
WITH e AS (
    SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, a.label AS own, e.vec_id, e.label, CAST(list_inner_product(a.v, e.v) AS BIGINT) AS score
    FROM e AS a JOIN e ON a.vec_id <> e.vec_id WHERE a.vec_id % 50 = 0),
p AS (
    SELECT * FROM s WHERE own = label
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
    FROM p JOIN s ON p.anchor_id = s.anchor_id
    WHERE s.label <> s.own AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

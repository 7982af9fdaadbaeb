"""Exact top-k of vectors in tiles: some thousand queries against some thousand rows, each sent as a few packed blobs.

A tile's scores are made as floats, a chunk at a time, and compared with a bar that is below the query's k-th score so far by more
than a float's error. Only the few pairs above it are scored again, as doubles and pair by pair, and ranked: the result doesn't
depend on the tiles, and rows with equal vectors have equal scores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HITS = "query_id bigint, vec_id bigint, score double"
#: A side of tiles: rows of a block, of which the other side has ``n``; ``more`` and ``least`` are as in :func:`tile_search`.
PACKED = "list_id bigint, blk int, n int, ids binary, vecs binary, more binary, least binary"
#: Blocks of rows, and bytes of vectors, that a side of a tile has at most.
TILE_BLOCKS, TILE_BYTES = 16, 8 << 20
#: Rows and queries whose scores are made at once.
CHUNK_ROWS, CHUNK_QUERIES = 512, 2048
#: Pairs that are scored again at once, and that may wait for it.
PAIRS, WAITING = 1 << 13, 1 << 18
#: Doubles this close count as equal when many rows compete for the last places.
NOISE = 1e-13


def kind(df: DataFrame, vec: str = "vec") -> str:
    """How the vectors of a column are packed: floats stay floats."""
    return "<f4" if df.schema[vec].dataType.simpleString() == "array<float>" else "<f8"


def tile_rows(block_rows: int, dims: int, width: int = 4) -> int:
    """Rows of a side of a tile."""
    return max(1, min(TILE_BLOCKS * block_rows, TILE_BYTES // (width * max(1, dims))))


def blocks(rows, most: int, others, tasks: int) -> np.ndarray:
    """The blocks that each list's queries are cut into: of ``most`` rows, or less, to make tiles for all ``tasks``."""
    rows = np.asarray(rows)
    n = np.maximum(1, np.ceil(rows / most)).astype(int)
    more = max(1, -(-2 * tasks // max(1, int((n * np.asarray(others)).sum()))))
    return np.maximum(n, np.minimum(n * more, rows // CHUNK_QUERIES)).astype(int)


def matrix(column: pa.Array, kind: str) -> np.ndarray:
    """The vectors of an Arrow column, which has no null; a null component is NaN."""
    if not len(column):
        return np.zeros((0, 0), kind)
    sizes = pc.list_value_length(column)
    if len(pc.unique(sizes)) > 1:
        raise ValueError("vectors of different lengths")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(len(column), sizes[0].as_py()), kind)


def pieces(*keys: np.ndarray) -> Iterator[np.ndarray]:
    """The places of the rows that have the same keys."""
    if len(keys[0]):
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(order), bool)
        for key in keys:
            new[1:] |= np.diff(key[order]) != 0
        yield from np.split(order, np.flatnonzero(new))


def packed_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] + [pa.int32()] * 2 + [pa.binary()] * 4
    columns = zip(*rows, strict=True) if rows else [[]] * 7
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["list_id", "blk", "n", "ids", "vecs", "more", "least"])


def pack(df: DataFrame, vec_id: str, home: str | None = None) -> DataFrame:
    """``df`` (list_id, blk, n, an id and ``vec``; ``home``, a number in its list) as PACKED; rows without a vector are left out."""
    as_kind = kind(df)
    vec = F.col("vec").cast("array<float>" if as_kind == "<f4" else "array<double>").alias("vec")
    x = df.where(F.col("vec").isNotNull()).select(F.col("list_id").cast("bigint"), F.col("blk").cast("int"), F.col("n").cast("int"), F.col(vec_id).cast("bigint"), vec,
                                                  *([F.col(home).cast("int")] if home else []))

    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, blocks, n, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            vecs = matrix(batch.column(4), as_kind)
            homes = batch.column(5).to_numpy().astype("<i4") if home else None
            yield packed_batch([(lists[at[0]], blocks[at[0]], n[at[0]], ids[at].astype("<i8").tobytes(), vecs[at].tobytes(),
                                 homes[at].tobytes() if home else None, None) for at in pieces(lists, blocks)])

    return x.mapInArrow(packs, PACKED)


class _Side(NamedTuple):
    ids: np.ndarray
    vecs: np.ndarray
    norms: np.ndarray
    unit: np.ndarray

    def at(self, rows: np.ndarray) -> _Side:
        return _Side(*(x[rows] for x in self))

    def doubles(self, rows: np.ndarray) -> np.ndarray:
        return self.vecs[rows] / self.norms[rows, None]


def _side(ids: np.ndarray, vecs: np.ndarray) -> tuple[_Side, np.ndarray]:
    """The rows that have a direction, and their places."""
    norms = np.sqrt(np.einsum("ij,ij->i", vecs, vecs, dtype="float64")) if len(ids) else np.zeros(0)
    fine = np.flatnonzero(np.isfinite(norms) & (norms > 0))
    if len(fine) < len(ids):
        ids, vecs, norms = ids[fine], vecs[fine], norms[fine]
    unit = np.empty(vecs.shape, "float32")
    for i in range(0, len(ids), CHUNK_QUERIES):
        unit[i:i + CHUNK_QUERIES] = vecs[i:i + CHUNK_QUERIES] / norms[i:i + CHUNK_QUERIES, None]
    return _Side(ids, vecs, norms, unit), fine


def _runs(values: np.ndarray) -> np.ndarray:
    """The place of each of some sorted values among its equals."""
    starts = np.flatnonzero(np.diff(values, prepend=-1))
    return np.arange(len(values)) - np.repeat(starts, np.diff(np.append(starts, len(values))))


def _ordered(b: _Side, homes: np.ndarray, k: int) -> np.ndarray:
    """The rows by home and id; of a home's copies of one vector only the ``k`` with the least ids, as no other can be a hit."""
    order = np.lexsort((b.ids, homes))
    words = b.vecs.view("<u4")
    odd = np.random.default_rng(1).integers(1, 1 << 62, words.shape[1] + 1, dtype="uint64") | np.uint64(1)
    hashed = homes.astype("uint64") * odd[0]
    for i in range(0, len(words), CHUNK_ROWS):
        hashed[i:i + CHUNK_ROWS] += words[i:i + CHUNK_ROWS].astype("uint64") @ odd[1:]
    _, same, count = np.unique(hashed, return_inverse=True, return_counts=True)
    some = np.flatnonzero(count[same[order]] > 1)  # places of rows that may have copies
    if not len(some):
        return order
    key = np.hstack([homes[order[some]].astype("<i4")[:, None].view("u1"), b.vecs[order[some]].view("u1")])
    _, same = np.unique(np.ascontiguousarray(key).view(f"V{key.shape[1]}").ravel(), return_inverse=True)
    by = np.argsort(same, kind="stable")
    return np.delete(order, some[by[_runs(same[by]) >= k]])


def _chunks(homes: np.ndarray) -> Iterator[slice]:
    """Rows of one or several whole homes, or of a part of a long one."""
    ends = np.append(np.flatnonzero(np.diff(homes)) + 1, len(homes))
    begin = last = 0
    for end in ends:
        if end - begin > CHUNK_ROWS and last > begin:
            yield slice(begin, last)
            begin = last
        while end - begin > CHUNK_ROWS:
            yield slice(begin, begin + CHUNK_ROWS)
            begin += CHUNK_ROWS
        last = end
    if last > begin:
        yield slice(begin, last)


class _Best:
    """The best rows of some queries so far, and the bar that others must reach."""

    def __init__(self, q: _Side, b: _Side, k: int, least: np.ndarray, decimals: int | None):
        self.q, self.b, self.k, self.decimals = q, b, k, decimals
        # inner products of unit vectors of floats are wrong by less than this
        self.error = (q.unit.shape[1] + 8) * 2.0 ** -24
        self.rounding = 0.0 if decimals is None else 10.0 ** -decimals
        self.bar = np.maximum(least - self.error - self.rounding, -1.5).astype("float32")
        self.kept = (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        self.new: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def see(self, rows: slice, some: np.ndarray | None, banned: np.ndarray | None) -> None:
        """Compares the queries ``some`` (all if None) with ``rows`` but for ``banned`` pairs."""
        k, asked = self.k, self.q.unit if some is None else self.q.unit[some]
        s = self.b.unit[rows] @ asked.T
        if banned is not None:
            s[banned] = -2.0
        bar = self.bar if some is None else self.bar[some]
        good = s >= bar
        if len(s) > k and np.count_nonzero(good) > 4 * len(asked):
            # k of the parts' best rows are k rows: the k-th of them is no better than the k-th row
            cuts = np.linspace(0, len(s), min(len(s), max(4 * k, 16)) + 1).astype(int)
            best = np.stack([s[i:j].max(axis=0) for i, j in zip(cuts[:-1], cuts[1:], strict=True)])
            bar = np.maximum(bar, np.partition(best, len(best) - k, axis=0)[len(best) - k] - np.float32(2 * self.error + 2 * self.rounding))
            self.bar[slice(None) if some is None else some] = bar
            good = s >= bar
            if np.count_nonzero(good) > 32 * len(asked):
                good = self._crowd(rows, some, good)
        at = np.flatnonzero(good)
        if len(at):
            row, query = np.divmod(at, len(asked))
            self.new.append((query if some is None else some[query], row + rows.start))
            self.waiting += len(at)
            if self.waiting > min(max(8 * k * len(self.q.ids), 4 * PAIRS), WAITING):
                self.settle()

    def _crowd(self, rows: slice, some: np.ndarray | None, good: np.ndarray) -> np.ndarray:
        """Of many rows that floats can't tell apart, each query's ``k`` best by doubles, equal ones by id."""
        by_id = np.argsort(self.b.ids[rows], kind="stable")
        q = self.q.doubles(np.arange(len(self.q.ids)) if some is None else some)
        s = np.where(good[by_id], self.b.doubles(by_id + rows.start) @ q.T, -np.inf)
        if self.decimals is not None:
            s = np.round(s, self.decimals)
        kth = np.partition(s, len(s) - self.k, axis=0)[len(s) - self.k]
        equal = np.abs(s - np.where(np.isfinite(kth), kth, 2.0)) <= NOISE
        keep = (s > kth) | (equal & (np.cumsum(equal, axis=0) <= self.k))
        out = np.zeros_like(good)
        out[by_id] = keep & good[by_id]
        return out

    def settle(self) -> None:
        """Scores the waiting pairs, keeps each query's ``k`` best and lifts its bar."""
        if not self.waiting:
            return
        query, row = (np.concatenate(x) for x in zip(*self.new, strict=True))
        score = np.concatenate([np.einsum("ij,ij->i", self.q.doubles(query[i:i + PAIRS]), self.b.doubles(row[i:i + PAIRS])) for i in range(0, len(query), PAIRS)])
        if self.decimals is not None:
            score = np.round(score, self.decimals)
        query, row, score = (np.concatenate(x) for x in zip(self.kept, (query, row, score), strict=True))
        order = np.lexsort((self.b.ids[row], -score, query))
        nth = _runs(query[order])
        last = order[nth == self.k - 1]
        self.bar[query[last]] = np.maximum(self.bar[query[last]], (score[last] - self.error - self.rounding).astype("float32"))
        order = order[nth < self.k]
        self.kept, self.new, self.waiting = (query[order], row[order], score[order]), [], 0


def _tile(k: int, kinds: tuple[str, str], decimals: int | None) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def side(t: pa.Table, as_kind: str) -> tuple[_Side, np.ndarray, int]:
        blob = lambda c: b"".join(t[c].to_pylist())
        ids = np.frombuffer(blob("ids"), "<i8")
        x, fine = _side(ids, np.frombuffer(blob("vecs"), as_kind).reshape(len(ids), -1))
        return x, fine, len(ids)

    def blobs(t: pa.Table, column: str, as_kind: str) -> np.ndarray | None:
        return None if t[column].null_count else np.frombuffer(b"".join(t[column].to_pylist()), as_kind)

    def tile(qt: pa.Table, bt: pa.Table) -> pa.Table:
        found = []
        if qt.num_rows and bt.num_rows:
            q, q_fine, q_all = side(qt, kinds[0])
            b, b_fine, _ = side(bt, kinds[1])
            homes, wanted = blobs(bt, "more", "<i4"), blobs(qt, "more", "u1")
            homes = np.zeros(len(b.ids), "<i4") if homes is None else homes[b_fine]
            wanted = None if wanted is None else wanted.reshape(q_all, -1)[q_fine]
            least = blobs(qt, "least", "<f8")
            least = np.full(len(q.ids), -2.0) if least is None else least[q_fine]
            order = _ordered(b, homes, k)
            if len(q.ids) and len(b.ids) and q.vecs.shape[1] != b.vecs.shape[1]:
                raise ValueError("vectors of different lengths")
            b, homes = b.at(order), homes[order]
            chunks = [(c, np.unique(homes[c])) for c in _chunks(homes)]
            # a chunk of rows is compared with some thousand queries at once, however few of them want it
            share = 1.0 if wanted is None else max(np.unpackbits(wanted).mean(), 1 / 64)
            for i in range(0, len(q.ids), step := int(CHUNK_QUERIES / share)):
                asked = slice(i, i + step)
                best = _Best(q.at(asked), b, k, least[asked], decimals)
                wants = None if wanted is None else np.unpackbits(wanted[asked], axis=1).astype(bool)
                for rows, at in chunks:
                    if wants is None:
                        best.see(rows, None, None)
                        continue
                    want = wants[:, at]
                    come = np.flatnonzero(want.any(axis=1))
                    for j in range(0, len(come), 2 * CHUNK_QUERIES):
                        some = come[j:j + 2 * CHUNK_QUERIES]
                        banned = None if want[some].all() else ~want[some].T[np.searchsorted(at, homes[rows])]
                        best.see(rows, None if len(some) == len(wants) else some, banned)
                best.settle()
                query, row, score = best.kept
                found.append((best.q.ids[query], b.ids[row], score))
        columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [[]] * 3
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], ["query_id", "vec_id", "score"])

    return tile


def tile_search(q: DataFrame, b: DataFrame, k: int, kinds: tuple[str, str], decimals: int | None = None) -> DataFrame:
    """The ``k`` best rows of each tile for each of its queries: ``query_id, vec_id, score``.

    Both sides are PACKED. Block ``blk`` of a list's queries meets each of the ``n`` blocks of its rows, and the other way round.
    If ``more`` of the rows has their homes (int32), that of the queries has bits of the homes each may meet (whole bytes a query).
    ``least`` of the queries (double) is a score below which no row is wanted.
    """
    other = F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    qq = q.select("list_id", other.alias("bblk"), F.col("blk").alias("qblk"), "ids", "vecs", "more", "least")
    bb = b.select("list_id", F.col("blk").alias("bblk"), other.alias("qblk"), "ids", "vecs", "more")
    keys = ["list_id", "bblk", "qblk"]
    return qq.groupBy(*keys).cogroup(bb.groupBy(*keys)).applyInArrow(_tile(k, kinds, decimals), HITS)

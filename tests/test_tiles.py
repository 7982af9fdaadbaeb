"""Exact search in tiles: against brute force, and what is sent and scored on the way."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeloom.operators import tiles
from lakeloom.operators import vector as vx
from lakeloom.operators import vector_index as vi
from lakeloom.session import shared_dir

VECTORS = "vec_id long, embedding array<float>"


def brute(qids, q, ids, b, k, allowed=None, decimals=None):
    unit = lambda m: m.astype(float) / np.linalg.norm(m.astype(float), axis=1, keepdims=True)
    out = {}
    for i, x in enumerate(unit(q)):
        s = np.array([np.sum(x * y) for y in unit(b)])
        if decimals is not None:
            s = np.round(s, decimals)
        if allowed is not None:
            s[~allowed[i]] = -np.inf
        order = [j for j in np.lexsort((ids, -s))[:k] if s[j] > -np.inf]
        out[int(qids[i])] = [(int(ids[j]), round(float(s[j]), 9)) for j in order]
    return out


def tile(qids, q, ids, b, k, homes=None, wants=None, least=None, decimals=None, dtype="<f4"):
    blob = lambda x, t: None if x is None else np.ascontiguousarray(x, t).tobytes()
    bits = None if wants is None else np.packbits(wants, axis=1)
    table = lambda row: pa.table({c: pa.array([x], pa.binary()) for c, x in zip(("ids", "vecs", "more", "least"), row, strict=True)})
    got = tiles._tile(k, (dtype, dtype), decimals)(table((blob(qids, "<i8"), blob(q, dtype), blob(bits, "u1"), blob(least, "<f8"))),
                                                   table((blob(ids, "<i8"), blob(b, dtype), blob(homes, "<i4"), None)))
    out = {int(i): [] for i in qids}
    for r in sorted(got.to_pylist(), key=lambda r: (r["query_id"], -r["score"], r["vec_id"])):
        out[r["query_id"]].append((r["vec_id"], round(r["score"], 9)))
    return out


def rows(seed, n, dims=8, spread=1.0, groups=1):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(groups, dims))
    return (centers[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, dims))).astype("<f4")


@pytest.mark.parametrize("k,spread,dims", [(1, 1.0, 3), (5, 1.0, 64), (5, 1e-4, 8), (40, 0.05, 16), (900, 1.0, 8)])
def test_a_tile_equals_brute_force(monkeypatch, k, spread, dims):
    monkeypatch.setattr(tiles, "CHUNK_ROWS", 100)
    monkeypatch.setattr(tiles, "CHUNK_QUERIES", 16)
    monkeypatch.setattr(tiles, "PAIRS", 64)
    rng = np.random.default_rng(k)
    b, q = rows(1, 700, dims, spread, 5), rows(2, 40, dims, spread, 5)
    b[rng.integers(0, 700, 60)] = b[3]  # a hot vector
    b[5] = 0
    ids, qids = rng.permutation(700) - 350, rng.permutation(40)
    live = np.flatnonzero(b.any(axis=1))
    assert tile(qids, q, ids, b, k) == brute(qids, q, ids[live], b[live], k)
    # lists of 0 to 300 rows, each query in some of them; a bar that its k-th row just reaches
    homes = rng.choice(20, 700, p=np.r_[0.4, np.full(18, 0.6 / 18), 0])
    wants = rng.random((40, 20)) < 0.3
    wants[0] = False
    want = brute(qids, q, ids[live], b[live], k, wants[:, homes[live]])
    assert tile(qids, q, ids, b, k, homes, wants) == want
    s = np.array([want[i][-1][1] - 1e-9 if len(want[i]) == k else -2.0 for i in qids.tolist()])
    assert tile(qids, q, ids, b, k, homes, wants, s) == want


def test_many_rows_that_compete_for_the_last_place(monkeypatch):
    monkeypatch.setattr(tiles, "CHUNK_ROWS", 90)
    # sparse rows: nearly all are orthogonal to a query, so nearly all have its fifth score
    rng = np.random.default_rng(4)
    b = np.zeros((600, 50))
    b[np.arange(600), rng.integers(0, 50, 600)] = rng.integers(1, 9, 600)
    q = np.eye(60, 50)[:50] + 0.0
    q[:, 0] += 0.5
    b[rng.integers(0, 600, 300)] = np.eye(50)[7] * 2.0
    ids = rng.permutation(600)
    for decimals in (None, 9):
        assert tile(np.arange(50), q, ids, b, 5, decimals=decimals, dtype="<f8") == brute(np.arange(50), q, ids, b, 5, decimals=decimals)


def test_few_pairs_are_scored_twice(monkeypatch):
    scored = []
    settle = tiles._Best.settle
    monkeypatch.setattr(tiles._Best, "settle", lambda self: (scored.append(self.waiting), settle(self))[1])
    b, q = rows(5, 20_000, 32), rows(6, 300, 32)
    tile(np.arange(300), q, np.arange(20_000), b, 5)
    first, scored[:] = sum(scored), []
    assert first < 0.05 * 300 * 20_000
    # with a bar from the start, hardly more than the hits
    least = np.array([x[-1][1] for x in brute(np.arange(300), q, np.arange(20_000), b, 5).values()]) - 1e-9
    tile(np.arange(300), q, np.arange(20_000), b, 5, least=least)
    assert sum(scored) < 300 * 8


def test_copies_in_other_blocks_have_one_score(spark):
    v = [float(x) for x in rows(7, 1, 64)[0]]
    near = [v[:-1] + [v[-1] * (1 + 1e-6 * i)] for i in range(3)]
    base = spark.createDataFrame([(i, near[0]) for i in range(900, 0, -1)] + [(1000 + i, x) for i, x in enumerate(near)], VECTORS)
    q = spark.createDataFrame([(i, near[0]) for i in range(50)], "query_id long, embedding array<float>")
    hits = vx.vector_search(base, q, 7, blocked=True, block_rows=1).collect()  # blocks of 16 rows
    assert len(hits) == 350 and all(r["vec_id"] == r["rank"] for r in hits) and len({r["score"] for r in hits}) == 1


def test_vectors_are_sent_packed_and_probed_lists_alone_are_read(spark, monkeypatch):
    b = rows(8, 4000, 16, 0.05, 10)
    df = spark.createDataFrame([(i, x) for i, x in enumerate(b.tolist())], VECTORS).repartition(4)
    path = vi.build_index(df, shared_dir(spark, "index-test"), 10, "2024-01-01 00:00:00")
    sent = []
    whole = tiles.tile_search
    monkeypatch.setattr(tiles, "tile_search", lambda q, b, *more: (sent.append((q, b)), whole(q, b, *more))[1])
    some = df.where("vec_id < 2000")
    got = vi.search(spark, path, some, 5, query_id="vec_id").hits
    found = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 9)))
    assert found == brute(np.arange(2000), b[:2000], np.arange(4000), b, 5)
    for q, x in sent:
        # a row of packed vectors a batch and block, not a row a vector
        assert q.count() <= 60 and x.count() <= 60
        assert x.agg(F.coalesce(F.sum(F.length("ids") / 8), F.lit(0))).first()[0] <= 4000
    one = vi.search(spark, path, df.limit(1), 5, nprobe=1, query_id="vec_id")
    assert one.looked.agg(F.sum("n")).first()[0] == one.probes.count() == 1
    assert sent[-1][1].agg(F.sum(F.length("ids") / 8)).first()[0] < 4000


def test_first_lists_are_in_probe_order():
    rng = np.random.default_rng(9)
    c = rng.normal(size=(30, 6))
    c[11] = c[4]
    lists = vi._Lists(np.arange(30) * 2, c / np.linalg.norm(c, axis=1, keepdims=True), np.full(30, 0.3), np.full(30, 1.6), np.ones(30))
    q = rng.normal(size=(50, 6))
    q[7] = c[4]
    q = vi.pd.Series(list(q))
    bound, order = lists.bounds(q)
    for first in (1, 2, 7, 29, 30, 99):
        again, near = lists.near(q, first)
        assert (again == bound).all()
        assert [set(np.flatnonzero(x)) for x in near] == [set(x[:first]) for x in order]


def test_queries_are_cut_for_all_tasks():
    assert tiles.blocks([10_000, 70_000], 65_536, [1, 1], 6).tolist() == [4, 8]
    assert tiles.blocks([100, 0], 65_536, [1, 1], 6).tolist() == [1, 1]
    assert tiles.blocks([650_000], 65_536, [10], 6).tolist() == [10]
    assert tiles.tile_rows(2000, 64) == 32_000 and tiles.tile_rows(2000, 1 << 30) == 1

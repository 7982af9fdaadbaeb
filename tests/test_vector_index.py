"""The stored vector index, the metric join, near-duplicate clusters, the stored embedder: against brute force."""

import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakeloom.operators import clusters
from lakeloom.operators import metric_join as mj
from lakeloom.operators import text_embedding as te
from lakeloom.operators import vector as vx
from lakeloom.operators import vector_index as vi
from lakeloom.session import shared_dir

VECTORS = "vec_id long, embedding array<float>"


def clustered(seed=0, groups=12, each=40, dims=8, spread=0.05):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(groups, dims))
    return [(g * each + i, [float(np.float32(x)) for x in centers[g] + rng.normal(scale=spread, size=dims)]) for g in range(groups) for i in range(each)]


def brute(rows, queries, k):
    unit = lambda m: np.array(m, float) / np.linalg.norm(np.array(m, float), axis=1, keepdims=True)
    ids = np.array([r[0] for r in rows])
    s = unit([q[1] for q in queries]) @ unit([r[1] for r in rows]).T
    return {(q[0], int(ids[j]), n + 1) for i, q in enumerate(queries) for n, j in enumerate(np.lexsort((ids, -s[i]))[:k])}


def found(hits):
    return {(r["query_id"], r["vec_id"], r["rank"]) for r in hits.collect()}


@pytest.fixture(scope="module")
def index(spark):
    rows = clustered()
    df = spark.createDataFrame(rows, VECTORS)
    return rows, df, vi.build_index(df, shared_dir(spark, "index-test"), 12, "2024-01-01 00:00:00")


def test_exact_search_reads_few_lists_of_clustered_rows(spark, index):
    rows, df, path = index
    queries = rows[::7]
    q = spark.createDataFrame(queries, VECTORS)
    got = vi.search(spark, path, q, 5, query_id="vec_id")
    assert found(got.hits) == brute(rows, queries, 5)
    share = vi.probed_share(got, q, vi.lists(spark, path).count()).first()[0]
    assert share < 0.5
    assert found(vi.search(spark, path, q, 600, query_id="vec_id", block_rows=50).hits) == brute(rows, queries, 600)


def test_tuned_probes_reach_the_recall(spark, index):
    rows, df, path = index
    probes = vi.tune_probes(spark, path, df, 5, recall=0.95, query_id="vec_id")
    got = found(vi.search(spark, path, df, 5, nprobe=probes, query_id="vec_id").hits)
    want = brute(rows, rows, 5)
    assert 1 <= probes <= 12
    assert len({x[:2] for x in got} & {x[:2] for x in want}) >= 0.95 * len(want)


def test_index_is_refreshed_without_a_new_fit(spark):
    rows = clustered(1)
    path = vi.build_index(spark.createDataFrame(rows[:300], VECTORS), shared_dir(spark, "index-test"), 8, "2024-01-01 00:00:00")
    centers = spark.read.parquet(f"{path}/centroids").collect()
    changed = [(i, v[::-1]) if i % 50 == 0 else (i, v) for i, v in rows[20:]]
    base = spark.createDataFrame(changed, VECTORS)
    s = vi.status(base, path).first()
    assert (s["indexed_rows"], s["pending_rows"], s["stale_rows"]) == (280 - 5, len(changed) - 275, 20 + 5)
    # a refresh that breaks off leaves the last version as it is, and the next one takes its place
    spark.createDataFrame([(9999, [1.0] * 8, 0.0, 1)], vi.ROWS).write.parquet(f"{path}/rows/refresh=1/list_id=0")
    assert vi.version(spark, path) == 0 and vi.live_rows(spark, path).where("vec_id = 9999").count() == 0
    assert vi.refresh_index(base, path, "2024-01-02 00:00:00") == 1
    s = vi.status(base, path).first()
    assert (s["coverage_percentage"], s["pending_rows"], s["stale_rows"], s["index_status"]) == (100.0, 0, 0, "READY")
    assert str(s["last_refresh_time"]) == "2024-01-02 00:00:00"
    assert found(vi.search(spark, path, base, 4, query_id="vec_id").hits) == brute(changed, changed, 4)
    # an older version can still be read
    assert found(vi.search(spark, path, base.limit(9), 4, query_id="vec_id", upto=0).hits) == brute(rows[:300], changed[:9], 4)
    # a refresh with nothing to do, and one that finds an id again that had gone
    assert vi.refresh_index(base, path, "2024-01-03 00:00:00") == 2
    again = spark.createDataFrame(changed + rows[:3], VECTORS)
    assert vi.refresh_index(again, path, "2024-01-04 00:00:00") == 3
    assert vi.live_rows(spark, path).count() == len(changed) + 3
    assert spark.read.parquet(f"{path}/centroids").collect() == centers
    with pytest.raises(ValueError):
        vi.build_index(base, path, 8, "2024-01-05 00:00:00")


def test_index_leaves_out_rows_without_direction(spark):
    rows = [(i, [float(i % 5 + 1), 1.0]) for i in range(40)] + [(100, None), (101, [0.0, 0.0]), (102, [float("nan"), 1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, VECTORS)
    path = vi.build_index(df, shared_dir(spark, "index-test"), 4, "2024-01-01 00:00:00")
    s = vi.status(df, path).first()
    assert (s["base_rows"], s["indexed_rows"], s["coverage_percentage"]) == (40, 40, 100.0)
    s = vi.status(df.limit(0), path).first()
    assert (s["base_rows"], s["stale_rows"], s["index_status"]) == (0, 40, "NOT READY")


@pytest.mark.parametrize("count,block_rows", [(1, 2000), (5, 7), (30, 2000)])
def test_metric_join_equals_all_pairs(spark, count, block_rows):
    rows = clustered(2, 6, 20) + [(1000 + i, [1.0] * 8) for i in range(25)] + [(2000, [0.0] * 8), (2001, None)]
    df = spark.createDataFrame(rows, VECTORS)
    for dist in (0.0005, 0.1, 0.8, 1.5):
        got = mj.similar_pairs(df, max_dist=dist, count=count, block_rows=block_rows).collect()
        live = [r for r in rows if r[1] is not None and any(r[1])]
        m = np.array([r[1] for r in live])
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        s = m @ m.T
        want = {(live[i][0], live[j][0]) for i in range(len(live)) for j in range(i + 1, len(live)) if s[i, j] >= 1 - dist}
        assert len(got) == len(want) and {(r["id_a"], r["id_b"]) for r in got} == want


def test_metric_join_looks_at_few_pairs_of_clustered_rows(spark):
    df = spark.createDataFrame(clustered(3), VECTORS)
    r = mj.examined(mj.dealt_cells(df, "vec_id", "embedding", 0.01)).first()
    assert r["rows"] == 480 and r["share_of_all_pairs"] < 0.35


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    for n, m in ((30, 10), (200, 180), (50, 300)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(1000, 1040)]
        parent = {}

        def root(x):
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        for a, b in edges:
            if a != b:
                a, b = sorted((root(a), root(b)))
                parent[b] = a
        got = {r["id"]: r["component"] for r in clusters.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
        assert got == {x: root(x) for x in parent}
    assert clusters.connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


def shingles(text):
    w = [x for x in "".join(c if c.isalnum() or c == "_" else " " for c in (text or "").lower()).split(" ") if x]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_clusters(rows, threshold):
    sets = {i: shingles(t) for i, t in rows}
    cluster = {i: i for i in sets}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                x, y = sorted((cluster[a], cluster[b]))
                cluster = {i: x if c == y else c for i, c in cluster.items()}
    return cluster


def test_near_duplicate_clusters_equal_brute_force(spark):
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(400)]
    base = [rng.choices(vocab, k=60) for _ in range(12)]
    rows = []
    for i in range(150):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(0, 9)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((i, " ".join(w)))
    rows += [(200, None), (201, ""), (202, " - "), (203, "One two"), (204, "one, TWO!"), (205, rows[3][1].upper())]
    got = clusters.near_duplicate_clusters(spark.createDataFrame(rows, "doc_id long, text string"), threshold=0.6, bands=64, rows_per_band=2,
                                           block_rows=11).collect()
    assert {r["id"]: r["cluster"] for r in got} == brute_clusters(rows, 0.6)


def test_a_bucket_whose_least_id_is_a_look_alike_keeps_its_pairs(spark):
    # 1 and 2 are alike; 0 shares most with either, so it is the least id of their buckets, but is alike to none
    words = [f"w{i}" for i in range(100)]
    rows = [(0, " ".join(words[:70] + [f"a{i}" for i in range(30)])), (1, " ".join(words)), (2, " ".join(words[:97] + ["x", "y", "z"]))]
    got = clusters.near_duplicate_clusters(spark.createDataFrame(rows, "doc_id long, text string"), bands=128, rows_per_band=1)
    assert {r["id"]: r["cluster"] for r in got.collect()} == {0: 0, 1: 1, 2: 1}


def test_signatures_are_made_once_a_row(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (2, None), (3, "")], "doc_id long, text string")
    kept = vx.minhash_signatures(df, "doc_id", "text", 5, 8, partitions=2).where(F.size("shingles") > 0)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    # a filter on the signatures isn't pushed below their repartition, which would make them twice
    assert len(re.findall(r"MapInArrow |ArrowEvalPython ", plan)) == 1
    rows = kept.collect()
    assert [(r["id"], len(r["shingles"]), len(r["sig"])) for r in rows] == [(1, 2, 8)]


def test_buckets_that_share_a_block_are_kept_apart(spark):
    sig = [7, 8, 9]
    left = pd.DataFrame({"query_id": [1, 2], "qvec": [[10, 1, *sig], [20, 2, *sig]]})
    right = pd.DataFrame({"vec_id": [5, 1, 2, 3, 4], "vec": [[20, 5, 1, 2, 3], [10, 1, *sig], [20, 2, *sig], [10, 3, *sig], [20, 2, *sig]]})
    got = clusters._candidates(0.6)(left, right)
    assert list(map(tuple, got.to_numpy())) == [(3, 1)]  # 4 is in the component of 2, 5 is unlike
    assert clusters._candidates(0.6)(left, right[:0]).empty


def test_a_hot_group_of_copies_is_one_cluster(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.range(600).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit(text)).otherwise(
        F.concat_ws(" ", *[F.concat(F.lit(f"v{i}_"), "id") for i in range(12)])).alias("text"))
    got = {r["id"]: r["cluster"] for r in clusters.near_duplicate_clusters(df).collect()}
    assert got == {i: 0 if i % 3 == 0 else i for i in range(600)}


def test_stored_embedder_puts_queries_into_the_same_space(spark):
    docs = spark.createDataFrame([(1, "red green blue"), (2, "green blue yellow yellow"), (3, "orange"), (4, None), (5, "Red, GREEN; blue.")],
                                 "doc_id long, text string")
    path = te.store(te.fit(docs, "text", 5), shared_dir(spark, "embedder"))
    model = te.load(path)
    base = te.embed(model, docs, "doc_id")
    rows = {r["doc_id"]: r for r in base.collect()}
    assert rows[4]["status"] == "NO_KNOWN_WORD" and rows[1]["embedding"] == rows[5]["embedding"]
    assert all(abs(sum(x * x for x in r["embedding"]) - 1) < 1e-9 for r in rows.values() if not r["status"])
    queries = spark.createDataFrame([(7, "blue red green"), (8, "nothing known"), (9, "yellow")], "q long, ask string")
    got = te.similar_texts(model, base, queries, "q", "ask", k=2).collect()
    assert sorted((r["query_id"], r["rank"], r["id"]) for r in got) == [(7, 1, 1), (7, 2, 5), (9, 1, 2)]
    assert {r["content"] for r in got if r["query_id"] == 9} == {"green blue yellow yellow"}


def test_empty_groups_of_a_blocked_search(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0], 0), (2, [0.0, 1.0], 5)], "query_id long, vec array<double>, list_id int")
    b = spark.createDataFrame([(7, [1.0, 0.0], 0)], "vec_id long, vec array<double>, list_id int")
    assert [(r["query_id"], r["vec_id"]) for r in vx.blocked_search(q, b, 3, block_rows=1).collect()] == [(1, 7)]


def test_metric_join_sends_a_row_once_to_a_block(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=16)]) for i in range(400)], VECTORS)
    dealt = mj.dealt_cells(df, "vec_id", "embedding", 0.9, 40)
    groups = vx.packed(dealt.sizes, 100)
    rows = dealt.homes.toPandas().assign(block=lambda x: groups[x["cell"]])
    sent, width = mj._sent(dealt, groups, np.ones(groups.max() + 1, int))
    frames = list(sent(rows))
    visits = dealt.visits(rows).sum()
    assert sum(len(c) for _, _, cells in frames for c in cells) == visits + 400  # with their own cells
    assert sum(len(at) for _, at, _ in frames) <= 400 * (groups.max() + 1) < visits
    assert [len(x) for x in vx.in_parts([rows], width, 100 * width)] == [100] * 4


def test_probes_are_grouped_and_never_broadcast(spark, index):
    rows, df, path = index
    groups = vx.packed([40] * 12, 120)
    assert groups.tolist() == [0] * 3 + [1] * 3 + [2] * 3 + [3] * 3 and vx.packed([1, 900, 1, 1], 100).tolist() == [0, 1, 2, 2]
    got = vi.search(spark, path, df, 5, nprobe=12, query_id="vec_id", block_rows=30)
    assert got.probes.count() == 480 * 12  # every list of every query, from one row a group
    plan = got.hits._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [query_id" in plan and "BroadcastHashJoin [query_id" not in plan
    assert found(got.hits) == brute(rows, rows, 5)

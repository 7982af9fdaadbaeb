"""Windows, top-k, vector search against brute force, similarity join, IVF, governance."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF
from lakeloom.operators import governance as gv
from lakeloom.operators import marts
from lakeloom.operators import vector as vx
from lakeloom.plans.tables import Tables
from lakeloom.sources.files import inline


def test_time_series_semantics(spark):
    df = inline(spark, [("A", 1, 10.0), ("A", 2, 0.0), ("A", 3, 5.0), ("B", 1, 2.0)], "k string, d int, close double")
    out = {(r.k, r.d): r for r in marts.time_series_metrics(df, "k", "d", "close", {"ma2": 2}, exact_scale=2).collect()}
    assert out[("A", 1)].daily_change is None and out[("A", 1)].ma2 == 10.0  # short first frame, NULL first LAG
    assert out[("A", 2)].daily_return_pct == -1.0
    assert out[("A", 3)].daily_return_pct is None  # zero divisor → NULL
    assert out[("A", 3)].ma2 == 2.5 and out[("B", 1)].ma2 == 2.0


def test_top_k_ties(spark):
    df = inline(spark, [("x", 1, 5), ("x", 2, 5), ("x", 3, 4), ("y", 4, 1)], "g string, id int, v int")
    got = sorted(map(tuple, marts.top_k_per(df, ["g"], [F.col("v").desc(), F.col("id")], 2, "rank").collect()))
    assert got == [("x", 1, 5, 1), ("x", 2, 5, 2), ("y", 4, 1, 1)]


def _brute(base, queries, k):
    B = np.stack(base.embedding.to_numpy()).astype(float)
    Q = np.stack(queries.embedding.to_numpy()).astype(float)
    B /= np.linalg.norm(B, axis=1, keepdims=True)
    Q /= np.linalg.norm(Q, axis=1, keepdims=True)
    S = Q @ B.T
    out = set()
    for i, qid in enumerate(queries.query_id):
        order = np.lexsort((base.vec_id.to_numpy(), -S[i]))[:k]
        out |= {(int(qid), int(base.vec_id.iloc[j]), r + 1) for r, j in enumerate(order)}
    return out


def test_vector_search_matches_brute_force(spark):
    e = Tables(spark, SF).embeddings
    queries = vx.label_centroids(e)
    want = _brute(e.toPandas(), queries.toPandas(), 5)
    fast = {(r.query_id, r.vec_id, r.rank) for r in vx.vector_search(e, queries, 5).collect()}
    assert fast == want
    # the blocked (non-broadcast) path gives the same exact answer
    q = queries.select("query_id", F.col("embedding").alias("vec"), F.lit(0).alias("list_id"))
    b = e.select("vec_id", F.col("embedding").alias("vec"), F.lit(0).alias("list_id"))
    blocked = {(r.query_id, r.vec_id, r.rank) for r in vx.blocked_search(q, b, 5, block_rows=37).collect()}
    assert blocked == want


def test_similar_pairs_matches_brute_force(spark):
    e = Tables(spark, SF).embeddings
    pdf = e.toPandas()
    B = np.stack(pdf.embedding.to_numpy()).astype(float)
    B /= np.linalg.norm(B, axis=1, keepdims=True)
    S = B @ B.T
    ids = pdf.vec_id.to_numpy()
    want = {(int(min(ids[i], ids[j])), int(max(ids[i], ids[j])))
            for i in range(len(ids)) for j in range(i + 1, len(ids)) if S[i, j] >= 0.3}
    got = {(r.id_a, r.id_b) for r in vx.similar_pairs(e, max_dist=0.7, block_rows=50).collect()}
    assert got == want


def test_ivf_recall_and_coverage(spark):
    e = Tables(spark, SF).embeddings
    assigned, centroids = vx.build_ivf(e, num_lists=4, seed=7)
    status = vx.index_status(e, assigned).first()
    assert status.coverage == 1.0
    queries = e.select(F.col("vec_id").alias("query_id"), "embedding")
    exact = vx.vector_search(e, queries, 5)
    full = vx.vector_search_ivf(assigned, centroids, queries, k=5, fraction=1.0)
    assert vx.recall_at_k(full, exact).first().recall == 1.0  # probing every list is exact
    part = vx.vector_search_ivf(assigned, centroids, queries, k=5, fraction=0.25)
    assert vx.recall_at_k(part, exact).first().recall <= 1.0


def test_governance(spark):
    df = inline(spark, [(1, 5.0, "a@b.com"), (2, 0.0, "x")], "id int, spent double, note string")
    assert gv.secured(df, {"analysts": F.col("spent") > 0}, ["nobody"]).count() == 0
    assert [r.id for r in gv.secured(df, {"analysts": F.col("spent") > 0}, ["analysts"]).collect()] == [1]
    assert gv.visible_columns(df, {"spent": ["finance"]}, ["support"]).columns == ["id", "note"]
    masked = gv.mask(df, {"note": "pii"}).collect()
    assert masked[0].note == "<email>"
    hits = {(r.column_name, r.pii_class): r.hits for r in gv.discover_pii(df).collect()}
    assert hits[("note", "email")] == 1


def test_near_duplicates(spark):
    text = "the quick brown fox jumps over the lazy dog while the cat sleeps in the warm sun all day long"
    df = inline(spark, [(1, text), (2, text + " today"), (3, "completely different words about spark jobs and shuffles here")],
                "doc_id long, text string")
    got = {(r.id, r.rep_id) for r in vx.dedupe_candidates(df, threshold=0.7).collect()}
    assert got == {(2, 1)}


def test_similar_pairs_ivf_prunes_but_never_invents(spark):
    e = Tables(spark, SF).embeddings
    exact = {(r.id_a, r.id_b) for r in vx.similar_pairs(e, max_dist=0.7, block_rows=50).collect()}
    assigned, centroids = vx.build_ivf(e, num_lists=4, seed=3)
    full = {(r.id_a, r.id_b) for r in vx.similar_pairs_ivf(assigned, centroids, 0.7, nprobe=4, block_rows=40).collect()}
    assert full == exact  # probing every list is the exact join
    pruned = {(r.id_a, r.id_b) for r in vx.similar_pairs_ivf(assigned, centroids, 0.7, nprobe=1).collect()}
    assert pruned <= exact


def test_embed_is_unit_length_and_drops_empty(spark):
    df = inline(spark, [(1, "spark shuffles data between stages"), (2, "   "), (3, "data lakes keep raw data")],
                "doc_id long, text string")
    out = {r.doc_id: r for r in vx.embed(df, "text", 64).collect()}
    assert set(out) == {1, 3}
    for r in out.values():
        assert abs(sum(x * x for x in r.embedding) - 1.0) < 1e-5 and r.status == ""


def test_ivf_assigns_every_row_once(spark):
    e = Tables(spark, SF).embeddings
    assigned, centroids = vx.build_ivf(e, num_lists=5, seed=11)
    assert assigned.count() == e.count() == assigned.select("vec_id").distinct().count()
    assert centroids.count() == 5
    assert assigned.agg(F.min("list_id"), F.max("list_id")).first() == (0, 4) or \
        assigned.select("list_id").distinct().count() <= 5

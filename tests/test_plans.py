"""Plan shapes that carry the scale guarantees: every keep-one / top-k / aggregate operator
reduces inside each task before its shuffle, on data where one key holds a third of the rows."""

from pyspark.sql import functions as F

from lakeloom.operators import dedupe as dd
from lakeloom.operators import marts, skew


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hot(spark):
    # key 0 holds a third of all rows
    base = spark.range(30000).select((F.col("id") % 3 == 0).cast("int").alias("hot"), F.col("id"))
    return base.select(F.when(F.col("hot") == 1, F.lit(0)).otherwise(F.col("id")).alias("k"),
                       F.col("id").alias("ts"), (F.col("id") * 7 % 101).alias("v"))


def test_latest_and_topk_limit_before_shuffle(spark):
    df = _hot(spark)
    for out in (dd.dedupe_latest(df, ["k"], "ts", ["v"]),
                marts.top_k_per(df, ["k"], [F.col("v").desc(), F.col("ts")], 3)):
        p = _plan(out)
        assert p.count("WindowGroupLimit") >= 2, p  # partial (map side) + final
        assert out.filter("k = 0").count() <= 3


def test_aggregates_are_partial(spark):
    df = _hot(spark)
    assert "partial_max_by" in _plan(marts.latest_agg(df, ["k"], ["ts", "v"]))
    assert "partial_min" in _plan(dd.dedupe_by_key(df, ["k"]))
    assert "partial_sum" in _plan(skew.salted_sum(df, ["k"], "v", salts=8))


def test_salted_sum_splits_the_hot_key(spark):
    df = _hot(spark)
    plain = {r.k: r.total for r in df.groupBy("k").agg(F.sum("v").alias("total")).collect()}
    salted = {r.k: r.total for r in skew.salted_sum(df, ["k"], "v", salts=8).collect()}
    assert salted == plain


def test_blocked_vector_groups_stay_bounded_under_a_hot_list(spark):
    from lakeloom.operators import vector as vx

    # list 0 holds a third of 3,000 base rows; every query probes list 0
    base = spark.range(3000).select(F.col("id").alias("vec_id"),
                                    F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50 + 1).alias("list_id"),
                                    F.array(F.lit(1.0), F.col("id").cast("double")).alias("vec"))
    queries = spark.range(600).select(F.col("id").alias("query_id"), F.lit(0).alias("list_id"),
                                      F.array(F.lit(1.0), F.lit(2.0)).alias("vec"))
    qq, bb, keys = vx._blocked_groups(queries, base, block_rows=100)
    biggest_b = bb.groupBy(*keys).count().agg(F.max("count")).first()[0]
    biggest_q = qq.groupBy(*keys).count().agg(F.max("count")).first()[0]
    assert biggest_b <= 150 and biggest_q <= 150  # ~block_rows per side (hash blocks), never the whole list
    # and the blocked search still answers every query
    hits = vx.blocked_search(queries, base, 3, block_rows=100)
    assert hits.select("query_id").distinct().count() == 600


def test_near_duplicate_cluster_is_a_star_not_all_pairs(spark):
    from lakeloom.operators import vector as vx

    text = " ".join(f"word{i}" for i in range(60))
    copies = spark.range(30).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    edges = vx.dedupe_candidates(copies, threshold=0.9)
    got = {(r.id, r.rep_id) for r in edges.collect()}
    assert got == {(i, 0) for i in range(1, 30)}  # 29 links to the smallest id, not 435 pairs


def test_hot_key_report_finds_the_third(spark):
    df = _hot(spark)
    top = skew.hot_keys(df, "k", n=3, min_share=0.01).collect()
    assert len(top) == 1 and top[0].key == 0 and abs(top[0].share - 1 / 3) < 1e-9
    assert [r.k for r in skew.skewed_keys(df, ["k"], min_share=0.2).collect()] == [0]

"""Dedupe family, MERGE/UPSERT/DELETE, CASE backfill, facade, skew helpers."""

from pyspark.sql import functions as F

from lakeloom.operators import dedupe as dd
from lakeloom.operators import skew
from lakeloom.operators import tables as tb
from lakeloom.sources.files import inline


def test_dedupe_literal(spark):
    df = inline(spark, [(1, "a"), (1, "a"), (2, "b"), (3, "c"), (3, "d")], "id int, value string")
    assert dd.dedupe_exact(df).count() == 4
    by_key = sorted(tuple(r) for r in dd.dedupe_by_key(df, ["id"]).collect())
    assert by_key == [(1, "a"), (2, "b"), (3, "c")]
    # idempotent
    assert sorted(map(tuple, dd.dedupe_exact(dd.dedupe_exact(df)).collect())) == sorted(map(tuple, dd.dedupe_exact(df).collect()))


def test_latest_forms_agree_with_ties(spark):
    df = inline(spark, [(1, 10, 1, "x"), (1, 10, 2, "y"), (1, 5, 3, "z"), (2, 1, 1, "w")],
                "id int, ts int, seq int, v string")
    agg = sorted(map(tuple, dd.dedupe_latest(df, ["id"], "ts", ["seq"]).select("id", "ts", "seq", "v").collect()))
    win = sorted(map(tuple, dd.dedupe_latest_window(df, ["id"], "ts", ["seq"]).select("id", "ts", "seq", "v").collect()))
    assert agg == win == [(1, 10, 2, "y"), (2, 1, 1, "w")]


def test_upsert_and_merge_insert(spark):
    target = inline(spark, [(1, "old"), (2, "keep")], "id int, value string")
    source = inline(spark, [(1, "new"), (3, "ins")], "id int, value string")
    assert sorted(map(tuple, tb.upsert(target, source, ["id"]).collect())) == [(1, "new"), (2, "keep"), (3, "ins")]
    staged = inline(spark, [(1, "x", 5), (3, "a", 1), (3, "b", 2), (None, "n", 9)], "id int, value string, ts int")
    tgt = inline(spark, [(1, "old", 0)], "id int, value string, ts int")
    merged, rejects = tb.merge_insert(tgt, staged, ["id"], "ts")
    assert sorted(map(tuple, merged.collect()), key=str) == sorted([(1, "old", 0), (3, "b", 2)], key=str)
    assert rejects.count() == 1
    # rerun inserts nothing new
    again, _ = tb.merge_insert(merged, staged, ["id"], "ts")
    assert again.count() == merged.count()


def test_backfill_case_order_and_delete(spark):
    df = inline(spark, [("Mozilla (iPhone; Mac OS X)",), ("Macintosh",), (None,), ("Windows NT 10",)], "browser string")
    out = [r.OS for r in tb.backfill_case(df, "OS", tb.os_branches("browser"), tb.OS_DEFAULT).collect()]
    assert out == ["iOS", "Mac", "Other/Unknown", "Windows"]
    d = inline(spark, [(1, "P"), (2, None), (3, "F")], "id int, s string")
    assert sorted(r.id for r in tb.delete_where(d, F.col("s") == "P").collect()) == [2, 3]


def test_facade_and_as_of(spark):
    old = inline(spark, [(1, "a", 1.234)], "key int, name string, amt double")
    new = inline(spark, [(2, "b", 2.5, "x")], "id int, name string, amt double, extra string")
    f = dd.facade(old, new, {"id": "key"}, {"amt": "decimal(10,2)"})
    assert sorted((r.id, r.extra) for r in f.collect()) == [(1, None), (2, "x")]
    h = inline(spark, [(1, 1, "a"), (1, 5, "b"), (1, 9, "c")], "k int, ts int, v string")
    assert tb.as_of(h, ["k"], "ts", "6").first().v == "b"


def test_salted_equals_unsalted(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    df = df.unionByName(spark.range(5000).select(F.lit(0).cast("bigint").alias("k"), F.col("id").alias("v")))
    plain = sorted(map(tuple, df.groupBy("k").agg(F.sum("v").alias("total")).collect()))
    assert sorted(map(tuple, skew.salted_sum(df, ["k"], "v", salts=7).collect())) == plain
    small = spark.range(3).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    hot = skew.skewed_keys(df, ["k"], min_share=0.3)
    salted = skew.salted_join(df, small, ["k"], salts=4, hot_keys=hot)
    assert salted.count() == df.join(small, "k").count()
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, df.join(small, "k").select(*salted.columns).collect()))


def test_large_groups_have_several_lists(spark):
    from lakeloom.operators import marts

    df = spark.range(500).select(F.lit(1).alias("k"), F.col("id").alias("v")).unionByName(spark.range(3).select(F.lit(2).alias("k"), F.col("id").alias("v")))
    assert marts.group_values(df, ["k"], "v", most=500).count() == 2
    rows = marts.group_values(df, ["k"], "v", most=50).collect()
    assert len([r for r in rows if r.k == 1]) == 10 and len([r for r in rows if r.k == 2]) == 1
    assert max(len(r.v_list) for r in rows) < 100
    assert sorted(v for r in rows if r.k == 1 for v in r.v_list) == list(range(500))
    both = marts.cogroup(df, df.filter("k = 2").withColumnRenamed("v", "w"), "k", "v", "w", most=50)
    assert sorted(v for r in both.collect() if r.k == 1 for v in r.v_list) == list(range(500))

"""Rows that a flow can't use are in its dead letters; writers replace what they own and nothing else."""

import os

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import skew
from lakeloom.operators import tables as tb
from lakeloom.plans import flows
from lakeloom.session import checkpoint_root, own_session, shared_dir
from lakeloom.sources import sinks
from lakeloom.sources.files import inline


def _name(root):
    return f"t_{root[-12:]}"


def test_daily_sales_keeps_rejects_and_reruns(spark):
    root = shared_dir(spark, "sales")
    rows = [("a", "2024-01-05", "1", "10.005", "1"), ("b", "2024-01-05", "1", "10.005", "2"), ("c", "2024-01-05", "1", "abc", "1"),
            ("d", "2024-13-05", "1", "1", "1"), ("e", "2024-02-01", None, "5", "1"), ("f", "2024-02-01", "2", "-5", "1")]
    inline(spark, rows, flows.SALES_SCHEMA).write.option("header", True).csv(f"{root}/src")
    for _ in range(2):
        report, letters = flows.run_daily_sales(spark, f"{root}/src", _name(root), f"{root}/report")
        assert [(r.product_id, float(r.total_sales), r.total_quantity) for r in report.collect()] == [(1, 20.01, 3.0)]
        assert {r.transaction_id: r.validation_errors for r in letters.collect()} == {
            "c": "AMOUNT_NOT_NUMERIC;", "d": "DATE_INVALID;", "e": "PRODUCT_INVALID;", "f": "AMOUNT_NEGATIVE;"}


def test_weblog_rejects_bad_casts(spark):
    root = shared_dir(spark, "weblog_bad")
    rows = [("1", "1", "2024-01-01 00:00:00", "/a", "5.0"), ("1", "2", "2024-01-01 00:00:00", "/a", "12x"), ("1", "3", "notime", "/a", "1"),
            ("x", "4", "2024-01-01 00:00:00", "/a", "1")]
    inline(spark, rows, flows.WEBLOG_STAGING_SCHEMA).write.option("header", True).csv(f"{root}/src")
    gold, silver = flows.run_weblog(spark, f"{root}/src", root)
    assert [(r.customer_id, float(r.total_spent)) for r in gold.collect()] == [(1, 5.0)] and silver.count() == 1
    letters = spark.read.json(f"{root}/dlq/run_date=2024-01-31")
    assert {r.log_id: r.cast_errors for r in letters.collect()} == {"2": "purchase_amount;", "3": "event_ts;", "4": "customer_id;"}


def test_upsert_partitions_leaves_null_partitions_alone(spark):
    root = shared_dir(spark, "null_part")
    inline(spark, [(None, 1, 5.0), ("m", 2, 1.0)], "p string, k int, v double").write.partitionBy("p").option("path", root).saveAsTable(_name(root))
    rejects = tb.upsert_partitions(spark, _name(root), inline(spark, [(None, 9, 7.0), ("m", 2, 3.0)], "p string, k int, v double"), ["p", "k"], "p")
    assert sorted(tuple(r) for r in spark.table(_name(root)).select("k", "v").collect()) == [(1, 5.0), (2, 3.0)]
    assert [(r.k, r.v) for r in rejects.collect()] == [(9, 7.0)]


def test_merge_refuses_a_repeated_key_and_takes_columns(spark):
    target = inline(spark, [(1, 10, "x")], "k int, a int, b string")
    with pytest.raises(Exception, match="more than once"):
        tb.upsert(target, inline(spark, [(1, 11, "p"), (1, 12, "q")], "k int, a int, b string"), ["k"]).collect()
    source = inline(spark, [(1, None, "new"), (2, 5, "ins")], "k int, a int, b string")
    assert sorted(map(tuple, tb.upsert(target, source, ["k"], update_cols=["b"]).collect())) == [(1, 10, "new"), (2, 5, "ins")]
    assert sorted(map(tuple, tb.upsert(target, source, ["k"]).collect()), key=str) == [(1, None, "new"), (2, 5, "ins")]


def test_delete_and_update_change_the_stored_table(spark):
    root = shared_dir(spark, "dml")
    rows = [(1, "a", "x"), (2, "a", "x"), (3, "b", "x"), (4, None, "x")]
    inline(spark, rows, "k int, p string, v string").write.partitionBy("p").option("path", root).saveAsTable(_name(root))
    tb.delete_from(spark, _name(root), F.col("k").isin(1, 3))
    assert sorted(r.k for r in spark.table(_name(root)).collect()) == [2, 4]
    assert not os.path.exists(f"{root.removeprefix('file:')}/p=b")
    tb.update_where(spark, _name(root), {"v": F.concat("v", F.lit("!"))}, F.col("k") == 2)
    assert sorted((r.k, r.v) for r in spark.table(_name(root)).collect()) == [(2, "x!"), (4, "x")]
    with pytest.raises(ValueError):
        tb.update_where(spark, _name(root), {"p": F.lit("z")}, F.lit(True))


def test_changes_of_a_replaced_table_leave_other_partitions(spark):
    root = shared_dir(spark, "dml2")
    df = inline(spark, [(1, "a"), (2, "b"), (3, "c")], "k int, p string")
    sinks.write_partitioned(df, _name(root), ["p"], path=root)
    tb.delete_from(spark, _name(root), F.col("p") == "b")
    tb.upsert_partitions(spark, _name(root), inline(spark, [(4, "c")], "k int, p string"), ["k", "p"], "p")
    assert sorted(r.k for r in spark.table(_name(root)).collect()) == [1, 3, 4]


def test_replaced_tables_lose_stale_partitions(spark):
    root = shared_dir(spark, "stale")
    df = inline(spark, [(1, "d1"), (2, "d2")], "k int, d string")
    sinks.write_partitioned(df, _name(root), ["d"], path=root)
    assert [r.k for r in sinks.write_partitioned(df.filter("d = 'd1'"), _name(root), ["d"], path=root).collect()] == [1]


def test_writers_rebalance_hot_partitions(spark):
    df = inline(spark, [(1, "a")], "k int, d string")
    assert "REBALANCE_PARTITIONS_BY_COL" in sinks.rebalanced(df, "d")._jdf.queryExecution().executedPlan().toString()


def test_salted_join_keeps_to_joins_that_are_right(spark):
    big, small = inline(spark, [(1, "a")], "k int, v string"), inline(spark, [(1, "x"), (2, "y")], "k int, w string")
    for how in ("right", "full_outer"):
        with pytest.raises(ValueError):
            skew.salted_join(big, small, ["k"], salts=4, how=how)
    assert skew.salted_join(big, small, ["k"], salts=4, how="left").count() == 1


def test_all_skewed_keys_are_found(spark):
    df = spark.range(6400).select((F.col("id") % 64).alias("k"))
    assert skew.skewed_keys(df, ["k"], min_share=0.01).count() == 64


def test_the_callers_session_stays_as_it_is(spark):
    before = dict(spark.conf.getAll)
    own = own_session(spark)
    own.conf.set("spark.sql.shuffle.partitions", "3")
    assert dict(spark.conf.getAll) == before
    assert checkpoint_root(own) == checkpoint_root(spark)

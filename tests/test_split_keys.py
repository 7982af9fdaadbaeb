"""Hot keys cut into ranges, segments and lists; runs measured while they write; versions by interval; gold from the first touched date."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF
from lakeloom.operators import marts, ml
from lakeloom.operators import quality as q
from lakeloom.operators import tables as tb
from lakeloom.plans import flows
from lakeloom.plans.tables import Tables
from lakeloom.session import shared_dir
from lakeloom.sources import sinks
from lakeloom.sources.files import inline


def hot(spark, n=6000, hot_share=3):
    """A third of the rows has key 0, some have none; many order values are equal."""
    return spark.range(n).select(
        F.when(F.col("id") % hot_share == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 97).cast("bigint").alias("k"),
        (F.col("id") * 7919 % 53).alias("v"), F.col("id"))


def test_row_rank_of_hot_keys_equals_the_plain_one(spark):
    df = hot(spark)
    want = marts.row_rank(df, ["k"], [F.col("v").desc(), F.col("id")], most=None)
    got = marts.row_rank(df, ["k"], [F.col("v").desc(), F.col("id")], most=100)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    tasks = got.where("k = 0").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 1
    assert marts.row_rank(df.limit(0), ["k"], [F.col("v")], most=100).count() == 0


def test_row_rank_of_one_order_value_is_cut_too(spark):
    df = spark.range(5000).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    got = marts.row_rank(df, ["k"], [F.col("v")], most=100)
    assert sorted(r["rn"] for r in got.collect()) == list(range(1, 5001))


def test_equal_values_are_dealt_to_several_lists(spark):
    df = spark.range(5000).select(F.lit(1).alias("k"), F.lit(7).alias("v"))
    rows = marts.value_lists(df, ["k"], "v", "vs", most=100).collect()
    assert len(rows) == 50 and {len(r["vs"]) for r in rows} == {100} and sorted(r["chunk_no"] for r in rows) == list(range(50))
    both = marts.cogroup(df, df.limit(130).withColumnRenamed("v", "w"), "k", "v", "w", most=100).collect()
    assert sum(len(r["w_list"]) for r in both) == 130 and max(len(r["v_list"]) for r in both) == 100


def test_lists_of_a_key_follow_one_another(spark):
    df = hot(spark)
    rows = marts.value_lists(df, ["k"], "v", "vs", most=150).collect()
    lists = {}
    for r in sorted(rows, key=lambda r: r["chunk_no"]):
        lists.setdefault(r["k"], []).extend(r["vs"])
    assert max(len(r["vs"]) for r in rows) <= 150
    want = {}
    for r in df.collect():
        want.setdefault(r["k"], []).append(r["v"])
    assert lists == {k: sorted(v) for k, v in want.items()}


@pytest.mark.parametrize("segment_rows", [29, 40])
def test_segmented_windows_equal_the_plain_ones(spark, segment_rows):
    rng = random.Random(segment_rows)
    rows = [(k, d, round(rng.uniform(-5, 50), 2)) for k, n in (("A", 300), ("B", 41), ("C", 1)) for d in range(n)]
    df = inline(spark, rows, "ticker string, date int, close double")
    want = marts.time_series_metrics(df, "ticker", "date", "close", exact_scale=2)
    got = marts.time_series_metrics(df, "ticker", "date", "close", exact_scale=2, segment_rows=segment_rows)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    with pytest.raises(ValueError):
        marts.time_series_metrics(df, "ticker", "date", "close", segment_rows=10)


def test_health_is_measured_by_the_write(spark):
    df = q.validate(hot(spark).withColumn("ts", F.timestamp_seconds("id").cast("timestamp_ntz")), [q.Rule("ODD", F.col("v") > 30)])
    path = shared_dir(spark, "checked")
    got = q.health_of(spark, q.write_checked(df, path, "ts"), "1970-01-02 00:00:00").first()
    clean, dlq = q.split(df)
    assert got == q.health(clean, dlq, "ts", "1970-01-02 00:00:00").first()
    assert spark.read.parquet(path).where("is_valid = 'true'").drop("is_valid", "validation_errors").count() == clean.count()
    empty = q.write_checked(df.limit(0), shared_dir(spark, "checked"), "ts")
    assert q.health_of(spark, empty, "1970-01-02 00:00:00").first()["processed"] == 0


def test_orphans_and_mismatches(spark):
    child = inline(spark, [(1, "a"), (1, "a"), (2, "b"), (9, "c"), (None, None)], "k int, s string")
    parent = inline(spark, [(1, "a"), (2, None), (2, "b"), (3, "z")], "p int, t string")
    assert tuple(q.orphans(child, ["k"], parent, ["p"], "x").first()) == ("x", 5, 2)
    assert tuple(q.orphans(child.limit(0), ["k"], parent, ["p"], "x").first()) == ("x", 0, 0)
    both = parent.withColumnRenamed("p", "k")
    assert tuple(q.mismatches(child, both, ["k"], "s", "t", "y").first()) == ("y", 4, 1)


def test_versions_by_interval_equal_the_history(spark):
    rng = random.Random(6)
    rows = [(rng.randrange(20), f"2024-0{rng.randrange(1, 7)}-1{rng.randrange(10)}", rng.randrange(5), i) for i in range(400)]
    h = inline(spark, rows, "k int, d string, t int, v int").withColumn("d", F.to_date("d"))
    path = shared_dir(spark, "versions")
    tb.store_versions(h, ["k"], "d", path, ["t", "v"])
    for day in ("2023-12-31", "2024-02-14", "2024-04-01", "2024-06-19", "2025-01-01"):
        want = sorted(map(tuple, tb.as_of(h, ["k"], "d", day, ["t", "v"]).collect()))
        assert sorted(map(tuple, tb.stored_as_of(spark, path, day).select("k", "d", "t", "v").collect())) == want
    plan = tb.stored_as_of(spark, path, "2024-04-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(closed" in plan and "2024-04-01" in plan.split("PartitionFilters")[1][:120]


def files_below(root):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(root.replace("file:", "")) for f in names
            if f.endswith(".parquet")}


def test_gold_is_recomputed_from_the_first_touched_date(spark):
    root = shared_dir(spark, "prices_touched")
    bars = flows.price_bars(Tables(spark, SF).events).withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    paths = (f"{root}/bronze", f"{root}/silver", f"{root}/dlq")
    sinks.land_bronze(bars.where("date <= '2024-01-25'"), paths[0], "ticker", "2024-01-25")
    flows.run_prices(spark, *paths, "2024-01-25", f"{root}/gold")
    before = files_below(f"{root}/gold")
    sinks.land_bronze(bars.where("date >= '2024-01-20'").withColumn("close", F.col("close") + 1), paths[0], "ticker", "2024-01-31")
    gold, silver = flows.run_prices(spark, *paths, "2024-01-31", f"{root}/gold")
    after = files_below(f"{root}/gold")
    old = {f for f in before if f.split("date=")[1][:10] < "2024-01-20"}
    assert old and all(after.get(f) == before[f] for f in old)
    assert not {f for f in before if f not in old} & set(after)
    want = flows.gold_metrics(silver)
    assert sorted(map(str, gold.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_every_error_code_fires(spark):
    qs = E.queries()
    codes = {"event_error_counts": 5, "validate_prices": 3, "validate_standard": 3, "validate_amount": 3}
    for key, n in codes.items():
        rows = qs[key](spark, "/root/testdata/sf0.01")
        if key != "event_error_counts":
            rows = q.error_counts(rows)
        counts = {r["error_code"]: r["n_errors"] for r in rows.collect()}
        assert len(counts) == n and min(counts.values()) > 0, (key, counts)


def test_features_of_earlier_days_only(spark):
    df = inline(spark, [("c", 1, 4.0), ("c", 2, 5.0), ("c", 3, 7.0), ("d", 2, 1.0)], "k string, day int, spent double")
    got = {(r["k"], r["day"]): r["earlier_spent"] for r in ml.earlier_days(df, "k", "day", ["spent"]).collect()}
    assert got[("c", 1)] == got[("d", 2)] == 0 and got[("c", 2)] == 1.609438 and got[("c", 3)] == 2.302585
    model = ml.train(inline(spark, [(float(i), "ab"[i % 2], float(i % 3 == 0)) for i in range(60)], "x double, c string, label double"), ["x"], ["c"],
                     encoder="target", reg_param=0.01, threshold=0.3)
    path = ml.store(model, shared_dir(spark, "model"))
    new = inline(spark, [(1.0, "a", 0.0), (1.0, "new", 0.0)], "x double, c string, label double")
    once, again = (ml.predict(m, new).collect() for m in (model, ml.load(path)))
    assert once == again and Counter(r["predicted_label"] in (0.0, 1.0) for r in once) == {True: 2}

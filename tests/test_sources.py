"""Readers and writers: corrupt-row routing, cast rejects, CSV inference, the seeded web-log
generator, DLQ idempotency."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF
from lakeloom.plans.tables import Tables
from lakeloom.session import path_exists, shared_dir
from lakeloom.sources import files, sinks
from lakeloom.sources.files import inline


def test_read_with_rejects(spark):
    root = shared_dir(spark, "rejects")
    spark.createDataFrame([('{"id": 1, "v": 2.5}',), ('{"id": 2, "v": ',), ('{"id": 3}',)], "value string") \
        .coalesce(1).write.text(root)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.DoubleType())])
    ok, rejects = files.read_with_rejects(spark, "json", root, schema)
    assert sorted(map(tuple, ok.collect())) == [(1, 2.5), (3, None)]
    assert [r.raw_record for r in rejects.collect()] == ['{"id": 2, "v": ']


def test_cast_or_reject(spark):
    df = inline(spark, [(1, "12.5"), (2, "x"), (3, None)], "id int, amount string")
    ok, rejects = files.cast_or_reject(df, {"amount": "decimal(10,2)"})
    assert sorted((r.id, None if r.amount is None else float(r.amount)) for r in ok.collect()) == [(1, 12.5), (3, None)]
    assert [(r.id, r.cast_errors) for r in rejects.collect()] == [(2, "amount;")]


def test_csv_inference_and_explicit_schema(spark):
    root = shared_dir(spark, "csv")
    Tables(spark, SF).customer.write.option("header", True).csv(root)
    inferred = files.read_csv(spark, root)
    assert dict(inferred.dtypes)["c_acctbal"] == "double"
    typed = files.read_csv(spark, root, Tables(spark, SF).customer.schema)
    assert typed.count() == Tables(spark, SF).customer.count()


def test_gen_weblog_distribution(spark):
    df = files.gen_weblog(spark, 5000, seed=42)
    s = df.agg(F.min("customer_id"), F.max("customer_id"), F.countDistinct("url"),
               F.avg((F.col("purchase_amount") > 0).cast("double")), F.max("purchase_amount")).first()
    assert s[0] >= 1 and s[1] <= 500 and s[2] == 5
    assert 0.25 < s[3] < 0.35 and s[4] <= 200
    again = files.gen_weblog(spark, 5000, seed=42)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, again.collect()))  # seeded: reproducible


def test_write_dlq_is_idempotent_and_clears_an_empty_rerun(spark):
    root = shared_dir(spark, "dlq")
    dlq = inline(spark, [(1, "A;"), (2, "B;")], "id int, validation_errors string")
    assert sinks.write_dlq(dlq, root, "2024-01-31")
    assert sinks.write_dlq(dlq, root, "2024-01-31")
    assert spark.read.json(f"{root}/run_date=2024-01-31").count() == 2
    assert not sinks.write_dlq(dlq.filter("id > 5"), root, "2024-02-01")
    # another date's letters stay in a session of either overwrite mode; a clean rerun clears its own
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        assert sinks.write_dlq(dlq, root, "2024-02-01")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert spark.read.json(f"{root}/run_date=2024-01-31").count() == 2
    assert not sinks.write_dlq(dlq.filter("id > 5"), root, "2024-01-31")
    assert not path_exists(spark, f"{root}/run_date=2024-01-31") and path_exists(spark, f"{root}/run_date=2024-02-01")

"""Registered queries: sources and sinks. Each writes data Spark derived from the driver's
tables into the shared folder, reads it back through the operator under test, and returns
what a downstream job would see."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators import dedupe as dd
from lakeloom.operators import governance, marts
from lakeloom.operators import quality as q
from lakeloom.plans import flows
from lakeloom.plans.catalog_quality import DOC_ERRORS_SQL, document_rules
from lakeloom.plans.registry import query
from lakeloom.plans.tables import Tables
from lakeloom.session import path_exists, shared_dir
from lakeloom.sources import files, sinks

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _table_name(root: str, prefix: str) -> str:
    return f"{prefix}_{root[-12:]}"


@query("scan_csv", oracle="SELECT * FROM customer")
def q_scan_csv(spark, sf):
    root = shared_dir(spark, "scan_csv")
    c = Tables(spark, sf).customer
    c.write.option("header", True).csv(root)
    return files.read_csv(spark, root, c.schema)


WEBLOG_RAW_SQL = """
SELECT user_id AS customer_id, event_id AS log_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp,
       '/' || event_type AS url,
       CASE WHEN event_type = 'purchase' THEN printf('%.2f', value) ELSE '0' END AS purchase_amount
FROM events"""


@query("load_csv_overwrite", oracle=WEBLOG_RAW_SQL)
def q_load_csv_overwrite(spark, sf):
    root = shared_dir(spark, "load_csv")
    flows.weblog_from_events(Tables(spark, sf).events).write.option("header", True).csv(f"{root}/src")
    name = _table_name(root, "web_log_raw")
    files.load_csv(spark, f"{root}/src", name, flows.WEBLOG_RAW_SCHEMA, path=f"{root}/table")
    return files.load_csv(spark, f"{root}/src", name, flows.WEBLOG_RAW_SCHEMA, path=f"{root}/table")  # rerun replaces


@query("scan_ndjson_glob", oracle="SELECT event_id, ts, user_id, value, props FROM events")
def q_scan_ndjson_glob(spark, sf):
    root = shared_dir(spark, "ndjson")
    sinks.land_bronze(Tables(spark, sf).events, root, "event_type", "2024-01-31")
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, value double, props string"
    return files.read_ndjson(spark, f"{root}/event_type=*/run_date=2024-01-31/*.json", schema)


@query("land_bronze", oracle="SELECT *, DATE '2024-01-31' AS run_date FROM events")
def q_land_bronze(spark, sf):
    root = shared_dir(spark, "bronze")
    e = Tables(spark, sf).events
    sinks.land_bronze(e, root, "event_type", "2024-01-31")
    sinks.land_bronze(e, root, "event_type", "2024-01-31")  # rerun replaces the same partitions
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, value double, props string"
    return spark.read.schema(schema + ", event_type string, run_date date").json(root)


@query("scan_table", oracle="SELECT * FROM events")
def q_scan_table(spark, sf):
    root = shared_dir(spark, "scan_table")
    name = _table_name(root, "events")
    sinks.replace_table(Tables(spark, sf).events, name, root)
    return files.read_table(spark, name)


@query("load_files", oracle="SELECT * FROM orders")
def q_load_files(spark, sf):
    root = shared_dir(spark, "load_files")
    Tables(spark, sf).orders.write.orc(f"{root}/src")
    return files.load_files(spark, "orc", f"{root}/src", _table_name(root, "orders"), "overwrite",
                            path=f"{root}/table")


@query("scan_suffix_range", oracle="""
SELECT event_id, ts, strftime(ts, '%Y%m%d') AS suffix FROM events
WHERE strftime(ts, '%Y%m%d') BETWEEN '20240105' AND '20240120'""")
def q_scan_suffix_range(spark, sf):
    root = shared_dir(spark, "suffix")
    e = Tables(spark, sf).events.select("event_id", "ts", F.date_format("ts", "yyyyMMdd").alias("suffix"))
    sinks.rebalanced(e, "suffix").write.partitionBy("suffix").parquet(root)
    out = files.read_suffix_range(spark, root, "20240105", "20240120")
    return out.select("event_id", "ts", F.col("suffix").cast("string").alias("suffix"))


@query("scan_corrupt", oracle="""
SELECT event_id, user_id, value, 'ok' AS branch FROM events WHERE event_type <> 'error'
UNION ALL SELECT NULL, NULL, NULL, 'reject' FROM events WHERE event_type = 'error'""")
def q_scan_corrupt(spark, sf):
    """NDJSON bronze where the 'error' events were landed truncated (cut before the closing
    brace) — the reader must route exactly those lines to the rejects."""
    root = shared_dir(spark, "corrupt")
    e = Tables(spark, sf).events
    line = F.to_json(F.struct("event_id", "user_id", "value"))
    text = F.when(F.col("event_type") == "error", F.expr("substring(to_json(struct(event_id, user_id, value)), 1, "
                                                          "length(to_json(struct(event_id, user_id, value))) - 1)")).otherwise(line)
    e.select(text.alias("value")).write.text(root)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                           T.StructField("value", T.DoubleType())])
    ok, rejects = files.read_with_rejects(spark, "json", root, schema)
    return ok.withColumn("branch", F.lit("ok")).unionByName(
        rejects.select(F.lit(None).cast("bigint").alias("event_id"), F.lit(None).cast("bigint").alias("user_id"),
                       F.lit(None).cast("double").alias("value"), F.lit("reject").alias("branch")))


# --- sinks ------------------------------------------------------------------------------------------

CUSTOMER_DAY_SQL = """
SELECT user_id AS customer_id, CAST(ts AS DATE) AS event_date, COUNT(*) AS total_events,
       CAST(SUM(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(38,9)) ELSE 0 END) AS DOUBLE) AS total_spent,
       COUNT(*) FILTER (WHERE event_type = 'purchase' AND value > 0) AS total_purchases
FROM events GROUP BY 1, 2"""


def customer_day_from_events(events):
    amount = F.when(F.col("event_type") == "purchase", F.col("value").cast("decimal(38,9)")).otherwise(
        F.lit(0).cast("decimal(38,9)"))
    out = marts.customer_day(events.withColumn("amount", amount), "user_id", "ts", "amount")
    return out.withColumn("total_spent", F.col("total_spent").cast("double"))


@query("agg_customer_day", oracle=CUSTOMER_DAY_SQL)
def q_agg_customer_day(spark, sf):
    return customer_day_from_events(Tables(spark, sf).events)


@query("replace_table", oracle=CUSTOMER_DAY_SQL)
def q_replace_table(spark, sf):
    root = shared_dir(spark, "replace")
    gold = customer_day_from_events(Tables(spark, sf).events)
    name = _table_name(root, "customer_summary_gold")
    sinks.replace_table(gold, name, root)
    return sinks.replace_table(gold, name, root)  # create-or-replace twice = once


@query("ctas_partition_cluster", oracle=CUSTOMER_DAY_SQL)
def q_ctas_partition_cluster(spark, sf):
    root = shared_dir(spark, "ctas_pc")
    gold = customer_day_from_events(Tables(spark, sf).events)
    name = _table_name(root, "customer_summary_gold")
    # a table that holds a day more is replaced whole: the day must not stay behind
    more = gold.unionByName(gold.withColumn("event_date", F.lit("1999-12-31").cast("date")))
    sinks.write_partitioned(more, name, ["event_date"], ["customer_id"], root)
    out = sinks.write_partitioned(gold, name, ["event_date"], ["customer_id"], root)
    return out.select("customer_id", "event_date", "total_events", "total_spent", "total_purchases")


@query("ctas_declared_schema", oracle="""
SELECT user_id AS customer_id, event_id AS log_id, ts AS event_ts, '/' || event_type AS url,
       CAST(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(38,9)) ELSE 0 END AS DOUBLE) AS purchase_amount
FROM events""")
def q_ctas_declared_schema(spark, sf):
    root = shared_dir(spark, "ctas_typed")
    raw = flows.weblog_from_events(Tables(spark, sf).events)
    typed = raw.select("customer_id", "log_id", F.to_timestamp_ntz("timestamp").alias("event_ts"), "url",
                       F.col("purchase_amount").try_cast("decimal(38,9)").alias("purchase_amount"))
    types = dict(flows.WEBLOG_SILVER_TYPES, event_ts="timestamp_ntz")
    out = sinks.write_typed(typed, _table_name(root, "web_log_silver"), types, root)
    return out.withColumn("purchase_amount", F.col("purchase_amount").cast("double"))


@query("append_table", oracle="SELECT * FROM orders UNION ALL SELECT * FROM orders")
def q_append_table(spark, sf):
    root = shared_dir(spark, "append")
    name = _table_name(root, "orders_log")
    o = Tables(spark, sf).orders
    sinks.append_table(o, name, root)
    return sinks.append_table(o, name, root)


@query("overwrite_table", oracle="SELECT * FROM orders")
def q_overwrite_table(spark, sf):
    root = shared_dir(spark, "overwrite")
    name = _table_name(root, "orders_clean")
    o = Tables(spark, sf).orders
    sinks.overwrite_table(o, name, root)
    return sinks.overwrite_table(o, name, root)


DOC_DLQ_SQL = f"SELECT doc_id, e AS validation_errors FROM (SELECT doc_id, {DOC_ERRORS_SQL} AS e FROM documents) WHERE e <> ''"


def _doc_dlq(spark, sf):
    _, dlq = q.split(q.validate(Tables(spark, sf).documents, document_rules()))
    return dlq.select("doc_id", "validation_errors")


@query("write_dlq_json", oracle=DOC_DLQ_SQL)
def q_write_dlq_json(spark, sf):
    root = shared_dir(spark, "dlq_json")
    dlq = _doc_dlq(spark, sf)
    sinks.write_dlq(dlq, root, "2024-01-30", "json")
    sinks.write_dlq(dlq, root, "2024-01-31", "json")
    sinks.write_dlq(dlq, root, "2024-01-31", "json")  # rerun replaces the run's partition
    sinks.write_dlq(dlq.limit(0), root, "2024-01-30", "json")  # a clean rerun clears it
    if path_exists(spark, f"{root}/run_date=2024-01-30"):
        raise ValueError("the cleared run left dead letters")
    return spark.read.schema("doc_id bigint, validation_errors string").json(f"{root}/run_date=2024-01-31")


@query("write_dlq_csv", oracle=DOC_DLQ_SQL)
def q_write_dlq_csv(spark, sf):
    root = shared_dir(spark, "dlq_csv")
    sinks.write_dlq(_doc_dlq(spark, sf), root, "2024-01-31", "csv")
    return files.read_csv(spark, f"{root}/run_date=2024-01-31", "doc_id bigint, validation_errors string")


@query("write_invalid_table", oracle=DOC_DLQ_SQL)
def q_write_invalid_table(spark, sf):
    root = shared_dir(spark, "dlq_table")
    return sinks.write_dlq_table(_doc_dlq(spark, sf), _table_name(root, "documents_invalid"), root)


@query("temp_view", oracle="""
SELECT o.o_orderkey AS order_id, n.n_name AS delivery_city, o.o_orderdate AS created_at
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def q_temp_view(spark, sf):
    from lakeloom.plans import topk_city
    t = Tables(spark, sf)
    root = shared_dir(spark, "views")
    view = _table_name(root, "orders_view")
    sinks.register(topk_city.orders_view(t.orders, t.customer, t.nation), view)
    return spark.sql(f"SELECT order_id, delivery_city, created_at FROM {view}")


#: Web-log rows of which some can't be read: a word as amount, a time that isn't one, no customer.
_BROKEN_LOG = {"amount": "event_id % 53 = 1", "time": "event_id % 59 = 2", "customer": "event_id % 61 = 3"}


@query("pipe_weblog", oracle=f"""
WITH read AS (SELECT * FROM events WHERE NOT ({_BROKEN_LOG["amount"]}) AND NOT ({_BROKEN_LOG["time"]}) AND NOT ({_BROKEN_LOG["customer"]}))
SELECT customer_id, event_date, total_events, total_spent, total_purchases, CAST(NULL AS VARCHAR) AS log_id, CAST(NULL AS VARCHAR) AS cast_errors
FROM ({CUSTOMER_DAY_SQL.replace("FROM events", "FROM read")}) WHERE total_spent > 0
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, CAST(event_id AS VARCHAR),
       CASE WHEN {_BROKEN_LOG["time"]} THEN 'event_ts;' ELSE '' END || CASE WHEN {_BROKEN_LOG["amount"]} THEN 'purchase_amount;' ELSE '' END
FROM events WHERE {_BROKEN_LOG["amount"]} OR {_BROKEN_LOG["time"]}""")
def q_pipe_weblog(spark, sf):
    """The log from CSV to the gold rows that analysts may see, and the rows that couldn't be read with the columns at fault."""
    root = shared_dir(spark, "weblog")
    log = flows.weblog_from_events(Tables(spark, sf).events)
    bad = lambda k: F.expr(_BROKEN_LOG[k].replace("event_id", "log_id"))
    log = log.withColumns({
        "purchase_amount": F.when(bad("amount"), F.lit("free")).otherwise(F.col("purchase_amount")),
        "timestamp": F.when(bad("time"), F.lit("yesterday")).otherwise(F.col("timestamp")),
        "customer_id": F.when(~bad("customer"), F.col("customer_id"))})
    log.write.option("header", True).csv(f"{root}/bronze")
    gold, _ = flows.run_weblog(spark, f"{root}/bronze", root)
    seen = governance.secured(gold, {"analysts": F.col("total_spent") > 0}, ["analysts"])
    rejects = spark.read.schema("log_id string, cast_errors string").json(f"{root}/dlq")
    return dd.union_all(seen.select("customer_id", "event_date", "total_events", F.col("total_spent").cast("double").alias("total_spent"),
                                    "total_purchases"), rejects, allow_missing=True).select(
        "customer_id", "event_date", "total_events", "total_spent", "total_purchases", "log_id", "cast_errors")

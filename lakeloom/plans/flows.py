"""End-to-end medallion flows (bronze → silver → gold), each one Spark application.

Every flow writes below a folder it is given (or a fresh one under the shared checkpoint
root) and returns the DataFrames of the tables it produced, read back from storage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators import dedupe as dd
from lakeloom.operators import marts, quality
from lakeloom.operators import tables as tb
from lakeloom.session import cut_lineage, path_exists, shared_dir
from lakeloom.sources import files, sinks


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


# --- exact-duplicate round trip -------------------------------------------------------------

def run_roundtrip(spark: SparkSession, src: DataFrame, root: str | None = None) -> DataFrame:
    """source → doubled table → exact dedupe → table; equals the distinct source."""
    root = root or shared_dir(spark, "roundtrip")
    doubled = sinks.replace_table(dd.union_all(src, src), _name("events_duplicated"), f"{root}/duplicated")
    return sinks.replace_table(dd.dedupe_exact(doubled), _name("events_deduplicated"), f"{root}/deduplicated")


# --- event quality ------------------------------------------------------------------------------

def run_events_dq(spark: SparkSession, events: DataFrame, root: str | None = None) -> tuple[DataFrame, DataFrame]:
    """events → rules + cleansing → (valid table, invalid table). Never writes its source."""
    root = root or shared_dir(spark, "events_dq")
    valid, invalid = quality.clean_events(events)
    v = sinks.replace_table(valid, _name("events_valid"), f"{root}/valid")
    i = sinks.write_dlq_table(invalid, _name("events_invalid"), f"{root}/invalid")
    return v, i


def events_as_web_events(events: DataFrame) -> DataFrame:
    """Driver ``events`` in the web-event layout the event rules expect.

    session = user and calendar day; city/browser come from the JSON props when present.
    """
    return events.select(
        F.col("event_id").cast("int").alias("id"),
        F.col("user_id").cast("int").alias("user_id"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        F.get_json_object("props", "$.city").alias("city"),
        F.get_json_object("props", "$.browser").alias("browser"),
        F.col("event_type"),
        F.col("ts").alias("created_at"),
    )


# --- price bars ---------------------------------------------------------------------------------

BAR_SCHEMA = "ticker string, date string, close double, volume bigint, event_id bigint"


def price_bars(events: DataFrame) -> DataFrame:
    """Daily bars from the event stream: ticker = event type, close = last value of the day
    (by ts, event id), volume = events that day. A two-stage aggregate (max_by)."""
    return (events.groupBy(F.col("event_type").alias("ticker"), F.to_date("ts").alias("date"))
                  .agg(F.max_by("value", F.struct("ts", "event_id")).alias("close"),
                       F.count(F.lit(1)).alias("volume"),
                       F.max("event_id").alias("event_id")))


def run_prices(spark: SparkSession, bronze_root: str, silver_path: str, dlq_root: str, run_date: str,
               gold_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """NDJSON bronze → validate → split → dedupe (ticker, date) → UPSERT silver, DLQ → gold.

    Silver is upserted on (ticker, date), not appended (defect D1), and the DLQ replaces its
    run-date partition (defect D13). A stored gold table is recomputed from the first date that the run touches: the
    months from there on, with the rows that the longest average reaches back to; dates before keep their files.
    Returns (gold, silver).
    """
    glob = f"{bronze_root}/ticker=*/run_date={run_date}/*.json"
    raw = files.read_ndjson(spark, glob, BAR_SCHEMA, base_path=bronze_root).withColumn("date", F.to_date("date"))
    checked = quality.validate(raw, quality.price_rules())
    clean, dlq = quality.split(checked)
    fresh = dd.dedupe_latest(clean, ["ticker", "date"], "event_id", [])
    fresh = cut_lineage(tb.with_partition(fresh, "date", "month", "month"))
    first = fresh.agg(F.min("date")).first()[0]
    if path_exists(spark, silver_path):
        # only the months that this run touches are read, merged and replaced
        stored = spark.read.parquet(silver_path)
        current = stored.join(fresh.select("month").distinct(), "month", "left_semi").select(*fresh.columns)
        fresh = cut_lineage(tb.upsert(current, fresh, ["ticker", "date"]))
    (sinks.rebalanced(fresh, "month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy("month").parquet(silver_path))
    sinks.write_dlq(dlq, dlq_root, run_date, "json")
    stored = spark.read.parquet(silver_path)
    silver = stored.drop("month")
    if not gold_path:
        return gold_metrics(silver), silver
    again = path_exists(spark, gold_path)
    if not again or first is not None:
        gold = gold_metrics_from(stored, first) if again else gold_metrics(silver)
        (sinks.rebalanced(gold, "date").sortWithinPartitions("date", "ticker").write.mode("overwrite")
              .option("partitionOverwriteMode", "dynamic" if again else "static").partitionBy("date").parquet(gold_path))
    return spark.read.parquet(gold_path), silver


#: Rows that a gold row's longest average reaches back to.
GOLD_HALO = 29


def gold_metrics_from(stored: DataFrame, first) -> DataFrame:
    """The gold rows from ``first`` on, of a silver table stored by month: rows before it are read for the averages only."""
    day = F.lit(first).cast("date")
    later = stored.where((F.col("month") >= F.trunc(day, "month")) & (F.col("date") >= day))
    before = marts.top_k_per(stored.where((F.col("month") <= F.trunc(day, "month")) & (F.col("date") < day)), ["ticker"],
                             [F.col("date").desc()], GOLD_HALO)
    return gold_metrics(before.unionByName(later).drop("month")).where(F.col("date") >= day)


def gold_metrics(silver: DataFrame) -> DataFrame:
    """close, volume, daily change, safe return (a fraction), 7/30-row moving averages."""
    out = marts.time_series_metrics(silver.select("ticker", "date", "close", "volume"), "ticker", "date", "close",
                                    exact_scale=2)
    return out.select("ticker", "date", "close", "volume", "daily_change", "daily_return_pct",
                      "moving_avg_7d", "moving_avg_30d")


# --- web log lakehouse ---------------------------------------------------------------------------

WEBLOG_RAW_SCHEMA = "customer_id long, log_id long, timestamp string, url string, purchase_amount string"
#: All text: a value that doesn't cast must reach the dead letters as it came.
WEBLOG_STAGING_SCHEMA = "customer_id string, log_id string, timestamp string, url string, purchase_amount string"
WEBLOG_SILVER_TYPES = {"customer_id": "bigint", "log_id": "bigint", "event_ts": "timestamp",
                       "url": "string", "purchase_amount": "decimal(38,9)"}


def weblog_from_events(events: DataFrame) -> DataFrame:
    """The driver's events in the raw web-log CSV layout (amount = value on purchases, else 0)."""
    return events.select(
        F.col("user_id").alias("customer_id"),
        F.col("event_id").alias("log_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
        F.concat(F.lit("/"), F.col("event_type")).alias("url"),
        F.when(F.col("event_type") == "purchase", F.format_string("%.2f", F.col("value"))).otherwise(F.lit("0")).alias("purchase_amount"),
    )


def run_weblog(spark: SparkSession, csv_paths, root: str, run_date: str = "2024-01-31") -> tuple[DataFrame, DataFrame]:
    """CSV → raw staging (overwrite) → typed silver (drop NULL customer) → customer-day gold.

    Rows with a value that doesn't cast go to the dead letters below ``root/dlq`` with the names
    of the columns that failed; they are in neither table. Returns (gold, silver)."""
    raw = files.load_csv(spark, csv_paths, _name("web_log_raw"), WEBLOG_STAGING_SCHEMA, skip_rows=1,
                         path=f"{root}/raw")
    typed, rejects = files.cast_or_reject(raw.withColumnRenamed("timestamp", "event_ts"), WEBLOG_SILVER_TYPES)
    sinks.write_dlq(rejects, f"{root}/dlq", run_date)
    silver = sinks.write_typed(typed.filter(F.col("customer_id").isNotNull()), _name("web_log_silver"), WEBLOG_SILVER_TYPES, f"{root}/silver")
    gold_df = marts.customer_day(silver, "customer_id", "event_ts", "purchase_amount")
    gold = sinks.write_partitioned(gold_df, _name("customer_summary_gold"), ["event_date"], ["customer_id"],
                                   f"{root}/gold")
    return gold, silver


# --- contacts quality -----------------------------------------------------------------------------

def run_contacts_dq(spark: SparkSession, csv_path: str, root: str, run_date: str) -> tuple[DataFrame, DataFrame]:
    """contacts CSV → email rules → (clean table, one error CSV with reasons)."""
    contacts = files.read_csv(spark, csv_path, "id string, email string")
    rules = [quality.Rule("ID_NOT_NUMERIC", F.col("id").isNotNull() & F.col("id").try_cast("bigint").isNull()),
             *quality.email_rules()]
    clean, dlq = quality.split(quality.validate(contacts, rules))
    out = sinks.overwrite_table(clean.withColumn("id", F.col("id").cast("bigint")), _name("contacts_clean"), f"{root}/clean")
    schema = "id string, email string, validation_errors string"
    if sinks.write_dlq(dlq, f"{root}/errors", run_date, "csv"):
        return out, files.read_csv(spark, f"{root}/errors/run_date={run_date}", schema)
    return out, spark.createDataFrame([], schema)


# --- daily product sales ---------------------------------------------------------------------------

SALES_SCHEMA = "transaction_id string, transaction_date string, product_id string, amount string, quantity string"


def sales_rules() -> list[quality.Rule]:
    """Amount rules, and dates, products and quantities that don't cast; a report key must not be NULL."""
    bad = lambda c, kind: F.col(c).isNull() | F.col(c).try_cast(kind).isNull()
    return [*quality.amount_rules("amount"), quality.Rule("DATE_INVALID", bad("transaction_date", "date")),
            quality.Rule("PRODUCT_INVALID", bad("product_id", "bigint")),
            quality.Rule("QUANTITY_INVALID", F.col("quantity").isNotNull() & F.col("quantity").try_cast("double").isNull())]


def daily_sales(transactions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Validated transactions → (per (date, product) totals, rejects with their error codes).

    Amounts are summed as they are, at nine decimals; only the total is rounded to cents.
    """
    clean, rejects = quality.split(quality.validate(transactions, sales_rules()))
    report = (clean.groupBy(F.col("transaction_date").cast("date").alias("transaction_date"), F.col("product_id").cast("bigint").alias("product_id"))
                   .agg(F.sum(F.col("amount").cast("decimal(38,9)")).cast("decimal(18,2)").alias("total_sales"),
                        F.sum(F.col("quantity").cast("double")).alias("total_quantity")))
    return report, rejects


def run_daily_sales(spark: SparkSession, csv_path: str, report_table: str, report_path: str,
                    run_date: str = "2024-01-31") -> tuple[DataFrame, DataFrame]:
    """raw transactions CSV → validate → daily product totals → UPSERT into the report table.

    The report is partitioned by month (derived from ``transaction_date``, so a key never
    changes partition); a run rewrites only the months it carries (``tables.upsert_partitions``).
    Rows that break a rule go to ``report_path-dlq`` under the run date. Returns (report, this run's rejects).
    """
    tx = files.read_csv(spark, csv_path, SALES_SCHEMA)
    fresh, rejects = daily_sales(tx)
    wrote = sinks.write_dlq(rejects, f"{report_path}-dlq", run_date)
    fresh = tb.with_partition(fresh, "transaction_date", "month", "transaction_month").select(
        "transaction_date", "product_id", "total_sales", "total_quantity", "transaction_month")
    if not spark.catalog.tableExists(report_table):
        sinks.write_partitioned(fresh, report_table, ["transaction_month"], path=report_path)
    else:
        tb.upsert_partitions(spark, report_table, fresh, ["transaction_date", "product_id", "transaction_month"],
                             "transaction_month")
    spark.catalog.refreshTable(report_table)
    schema = f"{SALES_SCHEMA}, validation_errors string"
    letters = spark.read.schema(schema).json(f"{report_path}-dlq/run_date={run_date}") if wrote else spark.createDataFrame([], schema)
    return spark.table(report_table), letters


def run_weblog_full(spark: SparkSession, csv_paths, root: str, principal_groups=("analysts",),
                    cut: str | None = None) -> dict:
    """The whole web-log lakehouse: staging → silver → gold → row policy → model.

    The model predicts ``label = total_purchases > 1`` from events and spend of the customer's earlier days,
    trained on days before ``cut`` and evaluated on the days from ``cut`` (a held-out period;
    with no ``cut`` it is evaluated on its training data, as the sample project does).
    Returns the DataFrames of each layer plus the fitted model.
    """
    from lakeloom.operators import governance, ml

    gold, silver = run_weblog(spark, csv_paths, root)
    secured = governance.secured(gold, {"analysts": F.col("total_spent") > 0}, principal_groups)
    known = ["earlier_total_events", "earlier_total_spent"]
    feats = ml.features(ml.earlier_days(gold, "customer_id", "event_date", ["total_events", "total_spent"]), known,
                        F.col("total_purchases") > 1, keep=["customer_id", "event_date"])
    train, test = ml.split_time(feats, "event_date", cut) if cut else (feats, feats)
    model = ml.train(train, known)
    return {
        "silver": silver, "gold": gold, "secured": secured, "model": model,
        "metrics": ml.evaluate(model, test),
        "predictions": ml.predict(model, feats, "will_return"),
    }

"""Registered queries: table changes (MERGE/UPSERT/UPDATE/DELETE, evolution, as-of, derived
partitions) and the flows built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions.columns import case_chain, is_true
from lakeloom.operators import dedupe as dd
from lakeloom.operators import tables as tb
from lakeloom.plans import flows
from lakeloom.plans.catalog_quality import BARS_SQL
from lakeloom.plans.registry import query
from lakeloom.plans.tables import Tables
from lakeloom.session import cut_lineage, shared_dir
from lakeloom.sources import sinks

# --- MERGE (insert only) ----------------------------------------------------------------------

_TARGET = "(SELECT o_orderkey AS id, o_totalprice AS value, o_orderdate AS ts FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')"
_MERGE_INSERT_ORACLE = f"""
SELECT * FROM {_TARGET}
UNION ALL
SELECT id, value, ts FROM (
  SELECT l_orderkey AS id, l_extendedprice AS value, l_shipdate AS ts FROM lineitem
  QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_extendedprice DESC) = 1)
WHERE id NOT IN (SELECT id FROM {_TARGET})"""


def _merge_insert(spark, sf):
    t = Tables(spark, sf)
    target = (t.orders.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
              .select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("value"), F.col("o_orderdate").alias("ts")))
    staged = t.lineitem.select(F.col("l_orderkey").alias("id"), F.col("l_extendedprice").alias("value"),
                               F.col("l_shipdate").alias("ts"))
    merged, _rejects = tb.merge_insert(target, staged, ["id"], "ts", ["value"])
    return merged


@query("merge_insert_only", oracle=_MERGE_INSERT_ORACLE)
def q_merge_insert_only(spark, sf):
    return _merge_insert(spark, sf)


@query("dedupe_post_merge", oracle=_MERGE_INSERT_ORACLE)
def q_dedupe_post_merge(spark, sf):
    """Staging → production table by appending the rows it lacks: run twice, the second run adds nothing."""
    root = shared_dir(spark, "post_merge")
    name = f"prod_{root[-12:]}"
    t = Tables(spark, sf)
    target = (t.orders.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
              .select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("value"), F.col("o_orderdate").alias("ts")))
    sinks.replace_table(target, name, root)
    staged = t.lineitem.select(F.col("l_orderkey").alias("id"), F.col("l_extendedprice").alias("value"),
                               F.col("l_shipdate").alias("ts"))
    for _ in range(2):
        new, _rejects = tb.rows_to_insert(spark.table(name), staged, ["id"], "ts", ["value"])
        sinks.append_table(cut_lineage(new), name, root)
    return spark.table(name)


# --- UPSERT ------------------------------------------------------------------------------------

_REPORT_SQL = """(SELECT CAST(l_shipdate AS DATE) AS transaction_date, l_partkey AS product_id,
   CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_sales, SUM(l_quantity) AS total_quantity
 FROM lineitem WHERE l_linestatus = '{s}' GROUP BY 1, 2)"""
_UPSERT_ORACLE = f"""
SELECT * FROM {_REPORT_SQL.format(s='F')} f
WHERE NOT EXISTS (SELECT 1 FROM {_REPORT_SQL.format(s='O')} o
                  WHERE o.transaction_date = f.transaction_date AND o.product_id = f.product_id)
UNION ALL SELECT * FROM {_REPORT_SQL.format(s='O')}"""


def _report(lineitem, status):
    return (lineitem.filter(F.col("l_linestatus") == status)
            .groupBy(F.to_date("l_shipdate").alias("transaction_date"), F.col("l_partkey").alias("product_id"))
            .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("total_sales"),
                 F.sum("l_quantity").alias("total_quantity")))


@query("merge_upsert", oracle=_UPSERT_ORACLE)
def q_merge_upsert(spark, sf):
    """A stored report, partitioned by month, takes the second half of the line items by MERGE."""
    li = Tables(spark, sf).lineitem
    root = shared_dir(spark, "merge_upsert")
    name = f"report_{root[-12:]}"
    month = lambda df: tb.with_partition(df, "transaction_date", "month", "transaction_month")
    sinks.write_partitioned(month(_report(li, "F")), name, ["transaction_month"], path=root)
    tb.upsert_partitions(spark, name, month(_report(li, "O")), ["transaction_date", "product_id", "transaction_month"], "transaction_month")
    return spark.table(name).drop("transaction_month")


def transactions_from_lineitem(lineitem, status):
    """Raw transactions (all text, as landed) from line items of one line status; some are broken on their way.

    By order and line: a word as amount, a negative one, none, a date that isn't one, no product.
    """
    k = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    at = lambda n, r: F.pmod(k, F.lit(n)) == r
    amount = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    return lineitem.filter(F.col("l_linestatus") == status).select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.when(at(97, 5), F.lit("2024-13-45")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("transaction_date"),
        F.when(~at(101, 7), F.col("l_partkey").cast("string")).alias("product_id"),
        F.when(at(89, 1), F.lit("abc")).when(at(89, 2), F.concat(F.lit("-"), amount)).when(~at(89, 3), amount).alias("amount"),
        F.col("l_quantity").cast("string").alias("quantity"))


_K = "(l_orderkey * 10 + l_linenumber)"
_BROKEN = f"({_K} % 97 = 5 OR {_K} % 101 = 7 OR {_K} % 89 IN (1, 2, 3))"
_SALES_SQL = """(SELECT CAST(l_shipdate AS DATE) AS transaction_date, l_partkey AS product_id,
   CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_sales, SUM(l_quantity) AS total_quantity
 FROM lineitem WHERE l_linestatus = '{s}' AND NOT """ + _BROKEN + """ GROUP BY 1, 2)"""
_SALES_ORACLE = f"""
SELECT transaction_date, product_id, total_sales, total_quantity, NULL AS transaction_id, NULL AS validation_errors
FROM {_SALES_SQL.format(s='F')} f
WHERE NOT EXISTS (SELECT 1 FROM {_SALES_SQL.format(s='O')} o
                  WHERE o.transaction_date = f.transaction_date AND o.product_id = f.product_id)
UNION ALL SELECT transaction_date, product_id, total_sales, total_quantity, NULL, NULL FROM {_SALES_SQL.format(s='O')}
UNION ALL SELECT NULL, NULL, NULL, NULL, l_orderkey || '-' || l_linenumber,
  CASE WHEN {_K} % 89 = 3 THEN 'AMOUNT_MISSING;' ELSE '' END || CASE WHEN {_K} % 89 = 1 THEN 'AMOUNT_NOT_NUMERIC;' ELSE '' END
  || CASE WHEN {_K} % 89 = 2 THEN 'AMOUNT_NEGATIVE;' ELSE '' END || CASE WHEN {_K} % 97 = 5 THEN 'DATE_INVALID;' ELSE '' END
  || CASE WHEN {_K} % 101 = 7 THEN 'PRODUCT_INVALID;' ELSE '' END
FROM lineitem WHERE l_linestatus IN ('F', 'O') AND {_BROKEN}"""


@query("pipe_daily_sales", oracle=_SALES_ORACLE)
def q_pipe_daily_sales(spark, sf):
    """Two runs into a month-partitioned report, and the dead letters of both."""
    root = shared_dir(spark, "daily_sales")
    li = Tables(spark, sf).lineitem
    name = f"daily_sales_{root[-12:]}"
    letters = []
    for i, status in enumerate(["F", "O"]):
        src = f"{root}/raw/run={i}"
        transactions_from_lineitem(li, status).write.option("header", True).csv(src)
        out, rejects = flows.run_daily_sales(spark, src, name, f"{root}/report", f"2024-01-0{i + 1}")
        letters.append(rejects.select("transaction_id", "validation_errors"))
    report = out.select("transaction_date", "product_id", F.col("total_sales").cast("double").alias("total_sales"), "total_quantity")
    return dd.union_all(report, *letters, allow_missing=True)


# --- schema evolution ------------------------------------------------------------------------------

# URL → channel, first match wins
CHANNEL_BRANCHES = [("%://m.%", "mobile"), ("%://blog.%", "blog"), ("%spam%", "spam")]
CHANNEL_SQL = """CASE WHEN url ILIKE '%://m.%' THEN 'mobile' WHEN url ILIKE '%://blog.%' THEN 'blog'
                      WHEN url ILIKE '%spam%' THEN 'spam' ELSE 'web' END"""


def _pages_table(spark, sf):
    root = shared_dir(spark, "pages_evolve")
    name = f"pages_{root[-12:]}"
    sinks.replace_table(Tables(spark, sf).pages.select("page_id", "url"), name, root)
    tb.add_column(spark, name, "channel", "string", "Channel derived from the URL")
    tb.add_column(spark, name, "channel", "string", "Channel derived from the URL")  # rerun: skipped
    return name


@query("add_column", oracle="SELECT page_id, url, CAST(NULL AS VARCHAR) AS channel FROM pages")
def q_add_column(spark, sf):
    return spark.table(_pages_table(spark, sf))


@query("update_case", oracle=f"SELECT page_id, url, {CHANNEL_SQL} AS channel FROM pages")
def q_update_case(spark, sf):
    """UPDATE of the stored table."""
    name = _pages_table(spark, sf)
    branches = [(is_true(F.col("url").ilike(p)), v) for p, v in CHANNEL_BRANCHES]
    tb.update_where(spark, name, {"channel": case_chain(branches, "web")}, F.col("channel").isNull())
    return spark.table(name)


@query("merge_schemas", oracle="""
SELECT o_orderkey, o_totalprice, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority
FROM orders""")
def q_merge_schemas(spark, sf):
    root = shared_dir(spark, "merge_schemas")
    o = Tables(spark, sf).orders
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    o.filter(F.col("o_orderdate") < cut).select("o_orderkey", "o_totalprice").write.parquet(f"{root}/part=old")
    o.filter(F.col("o_orderdate") >= cut).select("o_orderkey", "o_totalprice", "o_orderpriority") \
        .write.parquet(f"{root}/part=new")
    return tb.read_merged(spark, root).select("o_orderkey", "o_totalprice", "o_orderpriority")


@query("rename_retype", oracle="""
SELECT c_custkey, c_name, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal FROM customer
UNION ALL SELECT s_suppkey, s_name, CAST(s_acctbal AS DECIMAL(18,2)) FROM supplier""")
def q_rename_retype(spark, sf):
    t = Tables(spark, sf)
    new = t.customer.select("c_custkey", "c_name", "c_acctbal")
    return dd.facade(t.supplier, new, {"c_custkey": "s_suppkey", "c_name": "s_name", "c_acctbal": "s_acctbal"},
                     {"c_acctbal": "decimal(18,2)"})


@query("as_of", oracle="""
SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity FROM lineitem WHERE l_shipdate <= TIMESTAMP '1999-01-01'
QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_quantity DESC) = 1""")
def q_as_of(spark, sf):
    """Versions stored as validity intervals by the month in which they ended; the look-up skips what ended before."""
    h = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    path = shared_dir(spark, "versions")
    tb.store_versions(h, ["l_orderkey", "l_linenumber"], "l_shipdate", path, ["l_quantity"])
    return tb.stored_as_of(spark, path, "1999-01-01 00:00:00")


@query("as_of_price", oracle=f"""
SELECT ticker, date, close FROM {BARS_SQL} WHERE date <= DATE '2024-01-17'
QUALIFY ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY date DESC) = 1""")
def q_as_of_price(spark, sf):
    """The price that held on a day: a history of many short versions, stored by the day they ended."""
    bars = flows.price_bars(Tables(spark, sf).events).select("ticker", "date", "close")
    path = shared_dir(spark, "price_versions")
    tb.store_versions(bars, ["ticker"], "date", path, grain="week")
    return tb.stored_as_of(spark, path, "2024-01-17", grain="week")


@query("derived_partition", oracle="""
SELECT event_id, ts, CAST(ts AS DATE) AS ts_day FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'""")
def q_derived_partition(spark, sf):
    root = shared_dir(spark, "derived_partition")
    e = tb.with_partition(Tables(spark, sf).events.select("event_id", "ts"), "ts", "day", "ts_day")
    sinks.rebalanced(e, "ts_day").write.partitionBy("ts_day").parquet(root)
    back = spark.read.parquet(root)
    return tb.prune(back, "ts", "2024-01-10", "2024-01-20", "day", "ts_day").select("event_id", "ts", "ts_day")


@query("delete_rows", oracle="SELECT * FROM orders WHERE NOT coalesce(o_orderstatus = 'P', false)")
def q_delete_rows(spark, sf):
    """DELETE from a stored table partitioned by status: one partition is emptied and goes, none else is rewritten."""
    root = shared_dir(spark, "delete_rows")
    name = f"orders_{root[-12:]}"
    o = Tables(spark, sf).orders
    sinks.write_partitioned(o, name, ["o_orderstatus"], path=root)
    tb.delete_from(spark, name, F.col("o_orderstatus") == "P")
    if any("P" in r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()):
        raise ValueError("an emptied partition stayed")
    return spark.table(name).select(*o.columns)


# --- price flow -----------------------------------------------------------------------------------

PRICES_GOLD_ORACLE = f"""
WITH s AS (SELECT ticker, date, close, volume FROM {BARS_SQL})
SELECT ticker, date, close, volume,
  close - LAG(close) OVER w AS daily_change,
  (close - LAG(close) OVER w) / NULLIF(LAG(close) OVER w, 0) AS daily_return_pct,
  CAST(SUM(CAST(close AS DECIMAL(18,2))) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE)
    / COUNT(*) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS moving_avg_7d,
  CAST(SUM(CAST(close AS DECIMAL(18,2))) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS DOUBLE)
    / COUNT(*) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS moving_avg_30d
FROM s WINDOW w AS (PARTITION BY ticker ORDER BY date)"""


@query("pipe_prices", oracle=PRICES_GOLD_ORACLE)
def q_pipe_prices(spark, sf):
    """Two runs: the second run's lookback overlaps the first; silver is upserted, so gold
    counts each (ticker, date) once, and only the dates from the overlap on are written again."""
    root = shared_dir(spark, "prices")
    bars = flows.price_bars(Tables(spark, sf).events).withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    runs = [("2024-01-20", F.col("date") <= "2024-01-20"), ("2024-01-31", F.col("date") >= "2024-01-15")]
    gold = None
    for run_date, pred in runs:
        sinks.land_bronze(bars.filter(pred), f"{root}/bronze", "ticker", run_date)
        gold, _ = flows.run_prices(spark, f"{root}/bronze",
                                   f"{root}/silver", f"{root}/dlq", run_date, f"{root}/gold")
    return gold.select("ticker", "date", "close", "volume", "daily_change", "daily_return_pct",
                       "moving_avg_7d", "moving_avg_30d")


@query("win_lag_change", oracle=f"""
SELECT ticker, date, close - LAG(close) OVER (PARTITION BY ticker ORDER BY date) AS daily_change FROM {BARS_SQL}""")
def q_win_lag_change(spark, sf):
    from lakeloom.operators import marts
    bars = flows.price_bars(Tables(spark, sf).events)
    return marts.lag_change(bars, "ticker", "date", "close", "daily_change").select("ticker", "date", "daily_change")


@query("win_safe_return", oracle=f"""
SELECT ticker, date,
  (close - LAG(close) OVER w) / NULLIF(LAG(close) OVER w, 0) AS daily_return_pct
FROM {BARS_SQL} WINDOW w AS (PARTITION BY ticker ORDER BY date)""")
def q_win_safe_return(spark, sf):
    from lakeloom.operators import marts
    bars = flows.price_bars(Tables(spark, sf).events)
    return marts.lag_return(bars, "ticker", "date", "close", "daily_return_pct").select("ticker", "date", "daily_return_pct")


@query("win_moving_avg", oracle=f"""
SELECT ticker, date,
  CAST(SUM(CAST(close AS DECIMAL(18,2))) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE)
    / COUNT(*) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS moving_avg_7d
FROM {BARS_SQL} WINDOW w AS (PARTITION BY ticker ORDER BY date)""")
def q_win_moving_avg(spark, sf):
    from lakeloom.operators import marts
    bars = flows.price_bars(Tables(spark, sf).events)
    out = marts.time_series_metrics(bars, "ticker", "date", "close", {"moving_avg_7d": 7}, exact_scale=2, segment_rows=10_000)
    return out.select("ticker", "date", "moving_avg_7d")

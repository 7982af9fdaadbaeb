"""Registered queries: projections, filters, joins, aggregates, windows, sorts, set ops, skew.

Money and other 2-decimal values are summed as exact decimals and only then turned into
doubles, so the Spark result is bit-equal to the SQL oracle whatever the summation order.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeloom.functions import columns as cf
from lakeloom.operators import dedupe as dd
from lakeloom.operators import marts
from lakeloom.operators import skew
from lakeloom.plans import topk_city
from lakeloom.plans.registry import query
from lakeloom.plans.tables import Tables
from lakeloom.session import shared_dir


def money_sum(x) -> F.Column:
    return F.sum(cf.c(x).cast("decimal(18,2)")).cast("double")


LINE_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
LINE_ORDER_SQL = ", ".join(f"{x} DESC" for x in LINE_ORDER)


# --- 2.17 flagship -----------------------------------------------------------------------

@query("pipe_topk_city", oracle=topk_city.ORACLE)
def q_pipe_topk_city(spark, sf):
    """The whole flow, up to the table that each run replaces."""
    t = Tables(spark, sf)
    root = shared_dir(spark, "topk_city")
    return topk_city.run_topk(spark, t.orders, t.customer, t.nation, t.lineitem, f"top_items_{root[-12:]}", root)


# --- 2.3 projections and filters -----------------------------------------------------------

@query("project_rename", oracle="SELECT l_orderkey AS order_id, l_partkey AS item_id, l_quantity AS qty FROM lineitem")
def q_project_rename(spark, sf):
    return cf.project(Tables(spark, sf).lineitem, {"order_id": "l_orderkey", "item_id": "l_partkey", "qty": "l_quantity"})


@query("const_column", oracle="SELECT l_orderkey AS order_id, l_partkey AS item_id, 1 AS quantity, '' AS validation_errors FROM lineitem")
def q_const_column(spark, sf):
    items = cf.project(Tables(spark, sf).lineitem, {"order_id": "l_orderkey", "item_id": "l_partkey"})
    return cf.with_const(cf.with_const(items, "quantity", 1), "validation_errors", "")


@query("with_column", oracle="""
SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_level
FROM orders""")
def q_with_column(spark, sf):
    o = Tables(spark, sf).orders
    return cf.with_columns(o, {"o_year": F.year("o_orderdate"),
                               "priority_level": F.substring("o_orderpriority", 1, 1).cast("int")})


@query("drop_column", oracle="SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders")
def q_drop_column(spark, sf):
    return cf.drop(Tables(spark, sf).orders, "o_totalprice", "o_orderpriority")


@query("star_except_rename", oracle="SELECT * EXCLUDE (c_mktsegment), c_mktsegment AS segment FROM customer")
def q_star_except_rename(spark, sf):
    return cf.except_rename(Tables(spark, sf).customer, "c_mktsegment", "segment")


@query("qualified_star", oracle="""
SELECT C.*, O.o_orderkey, O.o_totalprice FROM customer C JOIN orders O ON C.c_custkey = O.o_custkey""")
def q_qualified_star(spark, sf):
    t = Tables(spark, sf)
    j = t.customer.alias("C").join(t.orders.alias("O"), F.col("C.c_custkey") == F.col("O.o_custkey"))
    return cf.select_star(j, "C", ["O.o_orderkey", "O.o_totalprice"])


@query("nested_field", oracle="""
SELECT c_custkey AS id, c_nationkey AS nation, c_mktsegment AS segment, c_acctbal AS balance FROM customer""")
def q_nested_field(spark, sf):
    c = Tables(spark, sf).customer
    nested = c.select(F.col("c_custkey").alias("id"),
                      F.struct(F.struct(F.col("c_nationkey").alias("nation")).alias("geo"),
                               F.struct(F.col("c_mktsegment").alias("segment"),
                                        F.col("c_acctbal").alias("balance")).alias("account")).alias("rec"))
    return cf.flatten(nested, {"nation": "rec.geo.nation", "segment": "rec.account.segment",
                               "balance": "rec.account.balance"}, keep=["id"])


_ORDERS_LEFT_LINES = """
SELECT o.o_orderkey, o.o_orderstatus, l.l_linenumber, l.l_partkey
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey"""


def _orders_left_lines(spark, sf):
    t = Tables(spark, sf)
    return (t.orders.select("o_orderkey", "o_orderstatus")
            .join(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"),
                  F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .select("o_orderkey", "o_orderstatus", "l_linenumber", "l_partkey"))


@query("filter_not_null", oracle=f"SELECT * FROM ({_ORDERS_LEFT_LINES}) WHERE l_partkey IS NOT NULL")
def q_filter_not_null(spark, sf):
    return cf.require_not_null(_orders_left_lines(spark, sf), "l_partkey")


@query("filter_null", oracle=f"SELECT * FROM ({_ORDERS_LEFT_LINES}) WHERE l_partkey IS NULL")
def q_filter_null(spark, sf):
    return cf.only_null(_orders_left_lines(spark, sf), "l_partkey")


@query("filter_since", oracle="""
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 1 YEAR""")
def q_filter_since(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderdate")
    return cf.since(o, "o_orderdate", "2001-08-01 00:00:00", "1 YEAR")


@query("filter_between", oracle="""
SELECT event_id, strftime(ts, '%Y%m%d') AS day_suffix FROM events
WHERE strftime(ts, '%Y%m%d') BETWEEN '20240105' AND '20240120'""")
def q_filter_between(spark, sf):
    e = Tables(spark, sf).events.select("event_id", F.date_format("ts", "yyyyMMdd").alias("day_suffix"))
    return cf.between(e, "day_suffix", "20240105", "20240120")


@query("filter_compare", oracle="""
SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem WHERE l_quantity <= 20 AND l_discount > 0""")
def q_filter_compare(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return li.filter((F.col("l_quantity") <= 20) & (F.col("l_discount") > 0))


@query("filter_bool_logic", oracle="""
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
WHERE (o_orderstatus = 'F' OR o_totalprice > 300000) AND NOT (o_orderpriority = '5-LOW')""")
def q_filter_bool_logic(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    pred = ((F.col("o_orderstatus") == "F") | (F.col("o_totalprice") > 300000)) & ~(F.col("o_orderpriority") == "5-LOW")
    return o.filter(cf.is_true(pred))


@query("filter_isin", oracle="SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def q_filter_isin(spark, sf):
    c = Tables(spark, sf).customer.select("c_custkey", "c_mktsegment")
    return c.filter(cf.in_list("c_mktsegment", ["BUILDING", "MACHINERY"]))


@query("filter_like_ci", oracle="SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%RED%' OR p_name ILIKE '%Bolt%'")
def q_filter_like_ci(spark, sf):
    p = Tables(spark, sf).part.select("p_partkey", "p_name")
    return p.filter(cf.ilike_any("p_name", ["%RED%", "%Bolt%"]))


EMAIL_SEARCH = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


@query("filter_regex", oracle=f"SELECT doc_id, lang FROM documents WHERE regexp_matches(text, '{EMAIL_SEARCH}')")
def q_filter_regex(spark, sf):
    d = Tables(spark, sf).documents
    return d.filter(cf.matches("text", EMAIL_SEARCH)).select("doc_id", "lang")


@query("route_split", oracle="""
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE 'kept' END AS branch
FROM lineitem""")
def q_route_split(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    yes, no = cf.route(li, F.col("l_returnflag") == "R")
    return dd.union_all(yes.withColumn("branch", F.lit("returned")), no.withColumn("branch", F.lit("kept"))).drop("l_returnflag")


# --- 2.4 joins ---------------------------------------------------------------------------

@query("join_inner_equi", oracle="""
SELECT o.o_orderkey AS order_id, o.o_orderdate AS created_at, l.l_partkey, l.l_quantity
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE o.o_orderdate >= TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 1 YEAR""")
def q_join_inner_equi(spark, sf):
    t = Tables(spark, sf)
    o = t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("created_at"))
    li = t.lineitem.select(F.col("l_orderkey").alias("order_id"), "l_partkey", "l_quantity")
    return marts.join_recent(o, li, "order_id", "created_at", "2001-08-01 00:00:00", "1 YEAR")


@query("join_enrich_federated", oracle="""
SELECT E.*, C.c_name, C.c_mktsegment FROM events E JOIN customer C ON E.user_id = C.c_custkey
ORDER BY E.event_id LIMIT 100""")
def q_join_enrich_federated(spark, sf):
    t = Tables(spark, sf)
    return marts.enrich(t.events, t.customer, "user_id", "c_custkey", ["c_name", "c_mktsegment"], ["event_id"], 100)


@query("join_cogroup", oracle="""
WITH l AS (SELECT l_orderkey AS k, array_to_string(list_sort(list(l_linenumber)), ',') AS lines FROM lineitem GROUP BY 1),
     o AS (SELECT o_orderkey AS k, array_to_string(list_sort(list(o_orderstatus)), ',') AS statuses FROM orders GROUP BY 1)
SELECT coalesce(l.k, o.k) AS order_key, CAST(0 AS BIGINT) AS chunk_no, coalesce(l.lines, '') AS lines, coalesce(o.statuses, '') AS statuses
FROM l FULL OUTER JOIN o ON l.k = o.k""")
def q_join_cogroup(spark, sf):
    t = Tables(spark, sf)
    li = t.lineitem.select(F.col("l_orderkey").alias("order_key"), "l_linenumber")
    o = t.orders.select(F.col("o_orderkey").alias("order_key"), "o_orderstatus")
    g = marts.cogroup(li, o, "order_key", "l_linenumber", "o_orderstatus")
    return g.select("order_key", "chunk_no", F.array_join("l_linenumber_list", ",").alias("lines"),
                    F.array_join("o_orderstatus_list", ",").alias("statuses"))


# --- 2.5 aggregates ------------------------------------------------------------------------

@query("agg_sum_by_keys", oracle="""
SELECT l_returnflag, l_linestatus, SUM(l_quantity) AS sum_qty,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def q_agg_sum_by_keys(spark, sf):
    li = Tables(spark, sf).lineitem
    return marts.combine(li, ["l_returnflag", "l_linestatus"],
                         {"sum_qty": F.sum("l_quantity"), "sum_price": money_sum("l_extendedprice")})


@query("agg_global_count", oracle="""
SELECT CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE 'kept' END AS branch, COUNT(*) AS row_count
FROM lineitem GROUP BY 1""")
def q_agg_global_count(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_returnflag")
    branch = F.when(F.col("l_returnflag") == "R", F.lit("returned")).otherwise(F.lit("kept"))
    return li.select(branch.alias("branch")).groupBy("branch").agg(F.count(F.lit(1)).alias("row_count"))


@query("combine_per_key", oracle="""
SELECT event_type, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value,
       COUNT(*) AS n_events,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS avg_value
FROM events GROUP BY event_type""")
def q_combine_per_key(spark, sf):
    e = Tables(spark, sf).events
    out = marts.combine(e, ["event_type"], {"total_value": money_sum("value"), "n_events": F.count(F.lit(1))})
    return out.withColumn("avg_value", F.col("total_value") / F.col("n_events"))


@query("combine_globally", oracle="""
SELECT CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value, COUNT(*) AS n_events,
       COUNT(DISTINCT user_id) AS n_users, MIN(ts) AS first_ts, MAX(ts) AS last_ts FROM events""")
def q_combine_globally(spark, sf):
    e = Tables(spark, sf).events
    return marts.combine(e, [], {"total_value": money_sum("value"), "n_events": F.count(F.lit(1)),
                                 "n_users": F.countDistinct("user_id"), "first_ts": F.min("ts"),
                                 "last_ts": F.max("ts")})


@query("group_by_key", oracle="""
SELECT l_orderkey, CAST(0 AS BIGINT) AS chunk_no, array_to_string(list_sort(list(l_linenumber)), ',') AS line_numbers FROM lineitem GROUP BY l_orderkey""")
def q_group_by_key(spark, sf):
    li = Tables(spark, sf).lineitem
    g = marts.group_values(li, ["l_orderkey"], "l_linenumber", "line_numbers")
    return g.select("l_orderkey", "chunk_no", F.array_join("line_numbers", ",").alias("line_numbers"))


_LATEST_LINE_ORACLE = f"""
SELECT l_orderkey, l_shipdate, l_linenumber, l_partkey, l_quantity FROM lineitem
QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER_SQL}) = 1"""


@query("latest_per_key_agg", oracle=_LATEST_LINE_ORACLE)
def q_latest_per_key_agg(spark, sf):
    li = Tables(spark, sf).lineitem
    return marts.latest_agg(li, ["l_orderkey"], LINE_ORDER).select(
        "l_orderkey", "l_shipdate", "l_linenumber", "l_partkey", "l_quantity")


@query("udaf_combine", oracle="""
SELECT user_id, event_id, ts, event_type FROM events
QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def q_udaf_combine(spark, sf):
    e = Tables(spark, sf).events.select("user_id", "event_id", "ts", "event_type")
    return marts.latest_agg(e, ["user_id"], ["ts", "event_id"])


@query("agg_rfm", oracle="""
SELECT user_id, CAST(date_diff('day', CAST(MAX(ts) AS DATE), DATE '2024-02-01') AS INTEGER) AS recency_days,
       COUNT(*) AS frequency, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS monetary
FROM events WHERE event_type = 'purchase' GROUP BY user_id""")
def q_agg_rfm(spark, sf):
    e = Tables(spark, sf).events.filter(F.col("event_type") == "purchase")
    e = e.withColumn("amount", F.col("value").cast("decimal(18,2)"))
    out = marts.rfm(e, "user_id", "ts", "amount", "2024-02-01")
    return out.withColumn("monetary", F.col("monetary").cast("double"))


# --- 2.6 windows ---------------------------------------------------------------------------

@query("win_topk_per_group", oracle="""
SELECT c_nationkey, c_custkey, c_acctbal,
       ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey ASC) AS rank
FROM customer QUALIFY rank <= 5""")
def q_win_topk_per_group(spark, sf):
    c = Tables(spark, sf).customer.select("c_nationkey", "c_custkey", "c_acctbal")
    return marts.top_k_per(c, ["c_nationkey"], [F.col("c_acctbal").desc(), F.col("c_custkey").asc()], 5, "rank")


@query("topk_per_group", oracle="""
SELECT p_brand, p_partkey, p_retailprice FROM part
QUALIFY ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey ASC) <= 3""")
def q_topk_per_group(spark, sf):
    p = Tables(spark, sf).part.select("p_brand", "p_partkey", "p_retailprice")
    return marts.top_k_per(p, ["p_brand"], [F.col("p_retailprice").desc(), F.col("p_partkey").asc()], 3)


_DOUBLED_EVENTS = "(SELECT * FROM events UNION ALL SELECT * FROM events)"


@query("win_dedupe_all_cols", oracle=f"SELECT DISTINCT * FROM {_DOUBLED_EVENTS}")
def q_win_dedupe_all_cols(spark, sf):
    e = Tables(spark, sf).events
    doubled = dd.union_all(e, e)
    w = Window.partitionBy(*doubled.columns).orderBy(F.lit(0))
    return doubled.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


@query("win_dedupe_key", oracle="""
SELECT event_type AS ticker, CAST(ts AS DATE) AS date, event_id, value FROM events
QUALIFY ROW_NUMBER() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY event_id DESC) = 1""")
def q_win_dedupe_key(spark, sf):
    e = Tables(spark, sf).events.select(F.col("event_type").alias("ticker"), F.to_date("ts").alias("date"),
                                        "event_id", "value")
    return marts.dedupe_by_order(e, ["ticker", "date"], [F.col("event_id").desc()])


@query("win_latest", oracle=_LATEST_LINE_ORACLE)
def q_win_latest(spark, sf):
    li = Tables(spark, sf).lineitem
    out = dd.dedupe_latest_window(li, ["l_orderkey"], "l_shipdate", LINE_ORDER[1:])
    return out.select("l_orderkey", "l_shipdate", "l_linenumber", "l_partkey", "l_quantity")


@query("win_rank_in_merge", oracle=f"""
SELECT l_orderkey, l_shipdate, l_linenumber, l_partkey, l_quantity,
       ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER_SQL}) AS rn
FROM lineitem""")
def q_win_rank_in_merge(spark, sf):
    li = Tables(spark, sf).lineitem
    out = marts.row_rank(li, ["l_orderkey"], [F.col(x).desc() for x in LINE_ORDER], "rn")
    return out.select("l_orderkey", "l_shipdate", "l_linenumber", "l_partkey", "l_quantity", "rn")


# --- 2.7 sorts and limits ------------------------------------------------------------------

@query("sort_multi", oracle="""
SELECT CAST(ts AS DATE) AS date, event_type AS ticker, COUNT(*) AS volume FROM events GROUP BY 1, 2 ORDER BY date DESC, ticker""")
def q_sort_multi(spark, sf):
    e = Tables(spark, sf).events
    bars = e.groupBy(F.to_date("ts").alias("date"), F.col("event_type").alias("ticker")).agg(F.count(F.lit(1)).alias("volume"))
    return marts.order(bars, [("date", "desc"), ("ticker", "asc")])


@query("topk_global", oracle="""
SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_spent FROM orders
GROUP BY o_custkey ORDER BY total_spent DESC, o_custkey LIMIT 10""")
def q_topk_global(spark, sf):
    o = Tables(spark, sf).orders
    s = o.groupBy("o_custkey").agg(money_sum("o_totalprice").alias("total_spent"))
    return marts.top_k(s, [F.col("total_spent").desc(), F.col("o_custkey")], 10)


@query("sort_limit_join", oracle="""
SELECT O.o_orderkey, O.o_orderdate, C.c_name FROM orders O JOIN customer C ON O.o_custkey = C.c_custkey
ORDER BY O.o_orderkey LIMIT 100""")
def q_sort_limit_join(spark, sf):
    t = Tables(spark, sf)
    return marts.enrich(t.orders.select("o_orderkey", "o_orderdate", "o_custkey"), t.customer, "o_custkey",
                        "c_custkey", ["c_name"], ["o_orderkey"], 100).drop("o_custkey")


@query("preview", oracle="SELECT * FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 10")
def q_preview(spark, sf):
    return marts.preview(Tables(spark, sf).lineitem, 10, [F.col(x) for x in ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]])


@query("limit_sample", oracle="SELECT * FROM orders ORDER BY md5('42|' || o_orderkey), o_orderkey LIMIT 100")
def q_limit_sample(spark, sf):
    """Seeded hash sample of 100 orders (a sampling operator: the limit is the feature)."""
    return marts.sample_n(Tables(spark, sf).orders, 100, seed=42, key_cols=["o_orderkey"])


# --- 2.8 set operations and dedupe -----------------------------------------------------------

@query("union_all", oracle=f"SELECT * FROM {_DOUBLED_EVENTS}")
def q_union_all(spark, sf):
    e = Tables(spark, sf).events
    return dd.union_all(e, e)


@query("dedupe_exact", oracle=f"SELECT DISTINCT * FROM {_DOUBLED_EVENTS}")
def q_dedupe_exact(spark, sf):
    e = Tables(spark, sf).events
    return dd.dedupe_exact(dd.union_all(e, e))


@query("pipe_dup_roundtrip", oracle="SELECT DISTINCT * FROM events")
def q_pipe_dup_roundtrip(spark, sf):
    from lakeloom.plans.flows import run_roundtrip
    return run_roundtrip(spark, Tables(spark, sf).events)


@query("distinct", oracle="SELECT DISTINCT text FROM documents")
def q_distinct(spark, sf):
    return dd.distinct(Tables(spark, sf).documents.select("text"))


@query("dedupe_by_key", oracle="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) = 1""")
def q_dedupe_by_key(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return dd.dedupe_by_key(li, ["l_orderkey", "l_linenumber"])


@query("dedupe_latest", oracle=f"""
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_quantity FROM lineitem
QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) = 1""")
def q_dedupe_latest(spark, sf):
    li = Tables(spark, sf).lineitem
    out = dd.dedupe_latest(li, ["l_orderkey", "l_linenumber"], "l_shipdate",
                           [x for x in LINE_ORDER[1:] if x != "l_linenumber"])
    return out.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_quantity")


@query("facade_union", oracle="""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier""")
def q_facade_union(spark, sf):
    t = Tables(spark, sf)
    return dd.facade(t.supplier, t.customer, {"c_custkey": "s_suppkey", "c_name": "s_name",
                                              "c_nationkey": "s_nationkey", "c_acctbal": "s_acctbal"})


# --- 2.16 user functions and skew ------------------------------------------------------------

@query("udf_flatmap", oracle="""
SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, parts[i] AS line
FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents), LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i)""")
def q_udf_flatmap(spark, sf):
    d = Tables(spark, sf).documents
    return d.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))


def _tag_event_udf():
    """Arrow-batched Python transform (built on first use: a pandas UDF needs a session)."""

    @F.pandas_udf("string")
    def tag_event(event_type: pd.Series, user_id: pd.Series) -> pd.Series:
        return event_type.str.upper() + "-" + user_id.astype("int64").astype(str)

    return tag_event


@query("udf_validate_transform", oracle="SELECT event_id, upper(event_type) || '-' || CAST(user_id AS VARCHAR) AS tag FROM events")
def q_udf_validate_transform(spark, sf):
    e = Tables(spark, sf).events
    return e.select("event_id", _tag_event_udf()("event_type", "user_id").alias("tag"))


@query("df_transform", oracle="""
SELECT l_orderkey, l_partkey, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(20,4)) AS revenue
FROM lineitem WHERE l_returnflag <> 'R'""")
def q_df_transform(spark, sf):
    def revenue(df):
        return df.withColumn("revenue", (F.col("l_extendedprice").cast("decimal(18,2)")
                                         * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(20,4)"))

    def not_returned(df):
        return df.filter(F.col("l_returnflag") != "R")

    li = Tables(spark, sf).lineitem
    return li.transform(not_returned).transform(revenue).select("l_orderkey", "l_partkey", "revenue")


@query("hot_keys", oracle="""
SELECT l_partkey AS key, COUNT(*) AS n, COUNT(*) / (SELECT COUNT(*) FROM lineitem) AS share
FROM lineitem GROUP BY l_partkey ORDER BY n DESC, key LIMIT 10""")
def q_hot_keys(spark, sf):
    return skew.hot_keys(Tables(spark, sf).lineitem, "l_partkey", 10, 0.0)


@query("salted_agg", oracle="""
SELECT l_returnflag, SUM(l_quantity) AS total FROM lineitem GROUP BY l_returnflag""")
def q_salted_agg(spark, sf):
    return skew.salted_sum(Tables(spark, sf).lineitem, ["l_returnflag"], "l_quantity", salts=16, alias="total")


@query("salted_join", oracle="""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, o.o_orderstatus
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def q_salted_join(spark, sf):
    t = Tables(spark, sf)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    # only measured hot keys are salted; the other rows of orders stay single
    return skew.salted_join(li, o, ["l_orderkey"], salts=8, hot_keys=skew.skewed_keys(li, ["l_orderkey"], min_share=0.01))


# --- 2.10 scalar functions -------------------------------------------------------------------

@query("scalar_functions", oracle=r"""
SELECT event_id,
  concat(event_type, '-', CAST(user_id AS VARCHAR)) AS tag,
  trim('  ' || event_type || ' ') AS trimmed,
  length(props) AS props_len,
  event_type ILIKE 'PUR%' AS is_purchase,
  regexp_matches(props, '"k": [0-9]{2}\}') AS two_digit_k,
  CAST(strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS ts_parsed,
  CAST(ts AS DATE) AS event_date,
  ts - INTERVAL 1 HOUR AS hour_before,
  CAST(ts AS DATE) - INTERVAL 5 DAY AS lookback_start,
  coalesce(try_strptime(CASE WHEN event_type = 'click' THEN strftime(ts, '%d/%m/%Y %H:%M') ELSE strftime(ts, '%Y-%m-%d %H:%M') END, '%Y-%m-%d %H:%M'),
           try_strptime(CASE WHEN event_type = 'click' THEN strftime(ts, '%d/%m/%Y %H:%M') ELSE strftime(ts, '%Y-%m-%d %H:%M') END, '%d/%m/%Y %H:%M')) AS ts_standard,
  value / NULLIF(CAST(user_id AS DOUBLE) - 100, 0) AS ratio,
  round(CAST(value AS DECIMAL(18,2)) * 3, 1) AS tripled,
  CAST(value AS DECIMAL(38,9)) AS amount,
  CASE WHEN value > 300 THEN 'high' WHEN value > 100 THEN 'mid' ELSE 'low' END AS band,
  CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_error,
  coalesce(json_extract_string(props, '$.missing'), 'none') AS missing_prop,
  json_extract_string(props, '$.missing') IS NULL AS missing_is_null,
  coalesce(CAST(json_extract_string(props, '$.missing') AS BIGINT), -1) AS filled,
  value > 100 AS big_value
FROM events""")
def q_scalar_functions(spark, sf):
    e = Tables(spark, sf).events
    std_src = F.when(F.col("event_type") == "click", F.date_format("ts", "dd/MM/yyyy HH:mm")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm"))
    out = e.select(
        "event_id",
        F.concat("event_type", F.lit("-"), F.col("user_id").cast("string")).alias("tag"),
        F.trim(F.concat(F.lit("  "), "event_type", F.lit(" "))).alias("trimmed"),
        F.length("props").alias("props_len"),
        F.col("event_type").ilike("PUR%").alias("is_purchase"),
        F.col("props").rlike(r'"k": [0-9]{2}\}').alias("two_digit_k"),
        F.to_timestamp(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz").alias("ts_parsed"),
        F.to_date("ts").alias("event_date"),
        (F.col("ts") - F.expr("INTERVAL 1 HOUR")).alias("hour_before"),
        F.date_sub(F.to_date("ts"), 5).cast("timestamp_ntz").alias("lookback_start"),
        cf.parse_timestamp(std_src, ["yyyy-MM-dd HH:mm", "dd/MM/yyyy HH:mm"]).cast("timestamp_ntz").alias("ts_standard"),
        cf.safe_divide(F.col("value"), F.col("user_id").cast("double") - 100).alias("ratio"),
        F.round(F.col("value").cast("decimal(18,2)") * 3, 1).alias("tripled"),
        cf.to_money("value").alias("amount"),
        cf.case_chain([(F.col("value") > 300, "high"), (F.col("value") > 100, "mid")], "low").alias("band"),
        F.expr("IF(event_type = 'error', 1, 0)").alias("is_error"),
        F.ifnull(F.get_json_object("props", "$.missing"), F.lit("none")).alias("missing_prop"),
        F.isnull(F.get_json_object("props", "$.missing")).alias("missing_is_null"),
        F.get_json_object("props", "$.missing").cast("bigint").alias("filled"),
        (F.col("value") > 100).alias("big_value"),
    )
    return out.fillna({"filled": -1})

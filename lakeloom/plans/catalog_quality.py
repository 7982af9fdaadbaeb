"""Registered queries: data quality (rules, dead letters, cleansing, measures) and DQ flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.operators import dedupe as dd
from lakeloom.operators import quality as q
from lakeloom.plans import flows
from lakeloom.plans.registry import query
from lakeloom.plans.tables import Tables
from lakeloom.session import shared_dir, spread
from lakeloom.sources import files

# fixed values: patterns shared by the document rules and their SQL oracle
EMAIL_SEARCH = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
IPV4_SEARCH = r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"
LANGS = ["en", "fr", "de", "es"]


def document_rules() -> list[q.Rule]:
    """Quality gate for raw documents: empty/short text, inconsistent length, unknown
    language, and personal data that must be reviewed before publishing."""
    return [
        q.Rule("TEXT_EMPTY", F.col("text").isNull() | (F.trim(F.col("text")) == "")),
        q.Rule("TOO_SHORT", F.col("n_chars") < 20),
        q.Rule("LENGTH_MISMATCH", F.col("n_chars") != F.length("text")),
        q.Rule("LANG_UNSUPPORTED", F.col("lang").isNull() | ~F.col("lang").isin(LANGS)),
        q.Rule("CONTAINS_EMAIL", F.col("text").rlike(EMAIL_SEARCH)),
        q.Rule("CONTAINS_IPV4", F.col("text").rlike(IPV4_SEARCH)),
    ]


DOC_ERRORS_SQL = f"""
  (CASE WHEN text IS NULL OR trim(text) = '' THEN 'TEXT_EMPTY;' ELSE '' END)
  || (CASE WHEN n_chars < 20 THEN 'TOO_SHORT;' ELSE '' END)
  || (CASE WHEN n_chars <> length(text) THEN 'LENGTH_MISMATCH;' ELSE '' END)
  || (CASE WHEN lang IS NULL OR lang NOT IN ('en', 'fr', 'de', 'es') THEN 'LANG_UNSUPPORTED;' ELSE '' END)
  || (CASE WHEN regexp_matches(text, '{EMAIL_SEARCH}') THEN 'CONTAINS_EMAIL;' ELSE '' END)
  || (CASE WHEN regexp_matches(text, '{IPV4_SEARCH}') THEN 'CONTAINS_IPV4;' ELSE '' END)"""


def _checked_docs(spark, sf):
    return q.validate(spread(Tables(spark, sf).documents, spark.sparkContext.defaultParallelism), document_rules())


@query("validate_rules", oracle=f"""
SELECT doc_id, {DOC_ERRORS_SQL} AS validation_errors, ({DOC_ERRORS_SQL}) = '' AS is_valid FROM documents""")
def q_validate_rules(spark, sf):
    return _checked_docs(spark, sf).select("doc_id", "validation_errors", "is_valid")


@query("split_valid_invalid", oracle=f"""
SELECT doc_id, lang, CASE WHEN e = '' THEN NULL ELSE e END AS validation_errors,
       CASE WHEN e = '' THEN 'clean' ELSE 'dlq' END AS branch
FROM (SELECT doc_id, lang, {DOC_ERRORS_SQL} AS e FROM documents)""")
def q_split_valid_invalid(spark, sf):
    clean, dlq = q.split(_checked_docs(spark, sf))
    return dd.union_all(clean.select("doc_id", "lang").withColumn("branch", F.lit("clean")),
                        dlq.select("doc_id", "lang", "validation_errors").withColumn("branch", F.lit("dlq")),
                        allow_missing=True)


@query("agg_error_table", oracle=f"""
SELECT code AS error_code, COUNT(*) AS n_errors
FROM (SELECT unnest(string_split({DOC_ERRORS_SQL}, ';')) AS code FROM documents) WHERE code <> '' GROUP BY code""")
def q_agg_error_table(spark, sf):
    _, dlq = q.split(_checked_docs(spark, sf))
    return q.error_counts(dlq)


@query("dq_profile", oracle="""
SELECT COUNT(*) AS rows,
       AVG(CAST(coalesce(text IS NOT NULL, false) AS DOUBLE)) AS complete_text,
       AVG(CAST(coalesce(lang IN ('en', 'fr', 'de', 'es'), false) AS DOUBLE)) AS conform_lang,
       AVG(CAST(coalesce(n_chars = length(text), false) AS DOUBLE)) AS consistent_length,
       AVG(CAST(coalesce(n_chars >= 20, false) AS DOUBLE)) AS long_enough
FROM documents""")
def q_dq_profile(spark, sf):
    d = Tables(spark, sf).documents
    return q.profile(d, {
        "complete_text": F.col("text").isNotNull(),
        "conform_lang": F.col("lang").isin(LANGS),
        "consistent_length": F.col("n_chars") == F.length("text"),
        "long_enough": F.col("n_chars") >= 20,
    })


# --- web events -----------------------------------------------------------------------------

#: Web events as a careless tracker would send them: some ids, users, times, sessions and cities are missing, empty or wrong.
WEB_SQL = """
(SELECT CASE WHEN event_id % 97 <> 1 THEN CAST(event_id AS INTEGER) END AS id,
        CASE WHEN event_id % 89 = 2 THEN -5 WHEN event_id % 83 <> 4 THEN CAST(user_id AS INTEGER) END AS user_id,
        CASE WHEN event_id % 73 = 4 THEN '  ' ELSE user_id || '-' || strftime(ts, '%Y%m%d') || ' ' END AS session_id,
        CASE WHEN event_id % 71 = 5 THEN '' WHEN event_id % 2 = 0 THEN ' city ' || user_id % 10 || ' ' END AS city,
        event_type, CASE WHEN event_id % 79 <> 3 THEN ts END AS created_at FROM events)"""
EVENT_ERRORS_SQL = """
  (CASE WHEN id IS NULL THEN 'ID_NULL;' ELSE '' END)
  || (CASE WHEN user_id IS NOT NULL AND user_id <= 0 THEN 'USER_ID_INVALID;' ELSE '' END)
  || (CASE WHEN created_at IS NULL THEN 'CREATED_AT_NULL;' ELSE '' END)
  || (CASE WHEN session_id IS NOT NULL AND trim(session_id) = '' THEN 'SESSION_ID_EMPTY;' ELSE '' END)
  || (CASE WHEN city IS NOT NULL AND trim(city) = '' THEN 'CITY_EMPTY;' ELSE '' END)"""


def web_events(events):
    """``events`` in the web-event layout, with the faults of :data:`WEB_SQL`."""
    at = lambda n: F.col("id") % n
    return flows.events_as_web_events(events).select(
        F.when(at(97) != 1, F.col("id")).alias("id"),
        F.when(at(89) == 2, F.lit(-5)).when(at(83) != 4, F.col("user_id")).alias("user_id"),
        F.when(at(73) == 4, F.lit("  ")).otherwise(F.concat("session_id", F.lit(" "))).alias("session_id"),
        F.when(at(71) == 5, F.lit("")).when(at(2) == 0, F.concat(F.lit(" city "), (F.col("user_id") % 10).cast("string"), F.lit(" "))).alias("city"),
        "browser", "event_type", F.when(at(79) != 3, F.col("created_at")).alias("created_at"))


@query("validate_events", oracle=f"SELECT id, city, {EVENT_ERRORS_SQL} AS validation_errors FROM {WEB_SQL}")
def q_validate_events(spark, sf):
    return q.validate(web_events(Tables(spark, sf).events), q.event_rules()).select("id", "city", "validation_errors")


@query("pipe_events_dq", oracle=f"""
SELECT id, coalesce(user_id, -1) AS user_id, trim(session_id) AS session_id, trim(city) AS city, trim(event_type) AS event_type, created_at,
       CASE WHEN ({EVENT_ERRORS_SQL}) <> '' THEN {EVENT_ERRORS_SQL} END AS validation_errors
FROM {WEB_SQL}""")
def q_pipe_events_dq(spark, sf):
    """Both tables of the flow: the valid events, and the invalid ones with their reasons."""
    valid, invalid = flows.run_events_dq(spark, web_events(Tables(spark, sf).events))
    return dd.union_all(valid, invalid, allow_missing=True).select(
        "id", "user_id", "session_id", "city", "event_type", "created_at", "validation_errors")


@query("event_error_counts", oracle=f"""
SELECT code AS error_code, COUNT(*) AS n_errors
FROM (SELECT unnest(string_split({EVENT_ERRORS_SQL}, ';')) AS code FROM {WEB_SQL}) WHERE code <> '' GROUP BY code""")
def q_event_error_counts(spark, sf):
    """Errors of the web events by code."""
    _, dlq = q.split(q.validate(web_events(Tables(spark, sf).events), q.event_rules()))
    return q.error_counts(dlq)


@query("cleanse_null_fill", oracle="""
SELECT c.c_custkey, coalesce(o.n_orders, 0) AS n_orders
FROM customer c LEFT JOIN (SELECT o_custkey, COUNT(*) AS n_orders FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey""")
def q_cleanse_null_fill(spark, sf):
    t = Tables(spark, sf)
    n = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    j = t.customer.select("c_custkey").join(n, F.col("c_custkey") == F.col("o_custkey"), "left").drop("o_custkey")
    return q.fill_null(j, {"n_orders": 0})


@query("cleanse_trim_all", oracle="""
SELECT conv_id, turn, trim(role) AS role, trim(text) AS text
FROM (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN '  ' || role WHEN turn % 3 = 1 THEN role || ' ' ELSE role END AS role,
             CASE WHEN turn % 2 = 0 THEN ' ' || text || '   ' ELSE text END AS text FROM conversations)""")
def q_cleanse_trim_all(spark, sf):
    """Turns whose roles and texts came with blanks around them."""
    c = Tables(spark, sf).conversations
    padded = c.withColumns({
        "role": F.when(F.col("turn") % 3 == 0, F.concat(F.lit("  "), "role")).when(F.col("turn") % 3 == 1, F.concat("role", F.lit(" "))).otherwise(F.col("role")),
        "text": F.when(F.col("turn") % 2 == 0, F.concat(F.lit(" "), "text", F.lit("   "))).otherwise(F.col("text"))})
    return q.trim_columns(padded, ["role", "text"])


# --- prices -------------------------------------------------------------------------------------

BARS_SQL = """
(SELECT b.ticker, b.date, c.value AS close, b.volume, b.event_id FROM
  (SELECT event_type AS ticker, CAST(ts AS DATE) AS date, COUNT(*) AS volume, MAX(event_id) AS event_id
   FROM events GROUP BY 1, 2) b
  JOIN (SELECT event_type, CAST(ts AS DATE) AS date, value FROM events
        QUALIFY ROW_NUMBER() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1) c
  ON b.ticker = c.event_type AND b.date = c.date)"""

PRICE_ERRORS_SQL = """
  (CASE WHEN close IS NULL OR close <= 0 THEN 'INVALID_CLOSE;' ELSE '' END)
  || (CASE WHEN volume IS NULL OR volume < 0 THEN 'INVALID_VOLUME;' ELSE '' END)
  || (CASE WHEN date IS NULL OR ticker IS NULL THEN 'MISSING_KEY;' ELSE '' END)"""


#: Bars of which some have no price or a negative one, a negative volume, or no date.
BROKEN_BARS_SQL = f"""
(SELECT ticker, CASE WHEN event_id % 13 <> 4 THEN date END AS date,
        CASE WHEN event_id % 7 = 1 THEN -close WHEN event_id % 7 <> 2 THEN close END AS close,
        CASE WHEN event_id % 5 = 3 THEN -volume ELSE volume END AS volume FROM {BARS_SQL})"""


@query("validate_prices", oracle=f"""
SELECT ticker, date, close, volume, {PRICE_ERRORS_SQL} AS validation_errors FROM {BROKEN_BARS_SQL}""")
def q_validate_prices(spark, sf):
    at = lambda n: F.col("event_id") % n
    bars = flows.price_bars(Tables(spark, sf).events).withColumns({
        "date": F.when(at(13) != 4, F.col("date")),
        "close": F.when(at(7) == 1, -F.col("close")).when(at(7) != 2, F.col("close")),
        "volume": F.when(at(5) == 3, -F.col("volume")).otherwise(F.col("volume"))})
    return q.validate(bars, q.price_rules()).select("ticker", "date", "close", "volume", "validation_errors")


# --- contacts -----------------------------------------------------------------------------------

CONTACT_SQL = r"""
(SELECT doc_id AS id, unnest(regexp_extract_all(text, '[^ \n]+@[^ \n]+', 0)) AS email FROM documents)"""
CONTACT_ERRORS_SQL = r"""
  (CASE WHEN id IS NULL THEN 'ID_NULL;' ELSE '' END)
  || (CASE WHEN email IS NULL THEN 'EMAIL_NULL;' ELSE '' END)
  || (CASE WHEN email IS NOT NULL AND NOT regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$') THEN 'EMAIL_INVALID;' ELSE '' END)"""


def contacts_from_documents(documents):
    """Contact rows derived from documents: every ``x@y`` token anywhere in each whole text."""
    return documents.select(F.col("doc_id").alias("id"),
                            F.explode(F.regexp_extract_all("text", F.lit(r"[^ \n]+@[^ \n]+"), 0)).alias("email"))


@query("validate_email", oracle=f"SELECT id, email, {CONTACT_ERRORS_SQL} AS validation_errors FROM {CONTACT_SQL}")
def q_validate_email(spark, sf):
    contacts = contacts_from_documents(Tables(spark, sf).documents)
    return q.validate(contacts, q.email_rules()).select("id", "email", "validation_errors")


@query("pipe_customer_dq", oracle=f"""
SELECT id, email, CASE WHEN e = '' THEN NULL ELSE e END AS validation_errors
FROM (SELECT id, email, {CONTACT_ERRORS_SQL} AS e FROM {CONTACT_SQL})""")
def q_pipe_customer_dq(spark, sf):
    root = shared_dir(spark, "contacts")
    contacts_from_documents(Tables(spark, sf).documents).write.option("header", True).csv(f"{root}/src")
    clean, errors = flows.run_contacts_dq(spark, f"{root}/src", root, "2024-01-31")
    errors = errors.withColumn("id", F.col("id").try_cast("bigint"))
    return dd.union_all(clean, errors, allow_missing=True).select("id", "email", "validation_errors")


# --- standard rules -------------------------------------------------------------------------------

# the allowed-country list of the standard check
ALLOWED_COUNTRIES = ["FRANCE", "GERMANY", "ROMANIA", "RUSSIA", "UNITED KINGDOM"]


#: Customers with the country of their nation's number; some lack their key or name.
COUNTRY_SQL = """
(SELECT CASE WHEN c_custkey % 43 <> 5 THEN c_custkey END AS c_custkey, CASE WHEN c_custkey % 41 <> 3 THEN c_name END AS c_name,
        CASE n_nationkey WHEN 0 THEN 'FRANCE' WHEN 1 THEN 'GERMANY' WHEN 2 THEN 'ROMANIA' WHEN 3 THEN 'RUSSIA' WHEN 4 THEN 'UNITED KINGDOM'
                         ELSE n_name END AS country
 FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""


@query("validate_standard", oracle=f"""
SELECT c_custkey, country,
  (CASE WHEN c_custkey IS NULL THEN 'C_CUSTKEY_NULL;' ELSE '' END)
  || (CASE WHEN c_name IS NULL THEN 'C_NAME_NULL;' ELSE '' END)
  || (CASE WHEN country IS NOT NULL AND country NOT IN ('FRANCE', 'GERMANY', 'ROMANIA', 'RUSSIA', 'UNITED KINGDOM')
           THEN 'COUNTRY_NOT_ALLOWED;' ELSE '' END) AS validation_errors
FROM {COUNTRY_SQL}""")
def q_validate_standard(spark, sf):
    t = Tables(spark, sf)
    country = F.coalesce(F.get(F.array(*[F.lit(x) for x in ALLOWED_COUNTRIES]), F.col("n_nationkey")), F.col("n_name"))
    df = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.when(F.col("c_custkey") % 43 != 5, F.col("c_custkey")).alias("c_custkey"),
        F.when(F.col("c_custkey") % 41 != 3, F.col("c_name")).alias("c_name"), country.alias("country"))
    clean, dlq = q.apply_standard_validations(df, ["c_custkey", "c_name"], "country", ALLOWED_COUNTRIES)
    return dd.union_all(clean.withColumn("validation_errors", F.lit("")), dlq).select("c_custkey", "country", "validation_errors")


# --- amounts --------------------------------------------------------------------------------------

#: An amount of each page as raw text: a path segment of its URL, or nothing, blanks, a word, a negative number.
PAGE_AMOUNT_SQL = r"""
(SELECT page_id, CASE page_id % 7 WHEN 1 THEN NULL WHEN 2 THEN '  ' WHEN 3 THEN 'n/a' WHEN 4 THEN '-' || page_id || '.50'
                 ELSE regexp_extract(url, '/[a-z][a-z]/([^?#]*)', 1) END AS amount FROM pages)"""


def page_amounts(pages):
    """The amounts of :data:`PAGE_AMOUNT_SQL`."""
    kind = F.col("page_id") % 7
    return pages.select("page_id", F.when(kind == 2, F.lit("  ")).when(kind == 3, F.lit("n/a"))
                        .when(kind == 4, F.concat(F.lit("-"), F.col("page_id").cast("string"), F.lit(".50")))
                        .when(kind != 1, F.regexp_extract("url", r"/[a-z][a-z]/([^?#]*)", 1)).alias("amount"))


AMOUNT_ERRORS_SQL = """(CASE WHEN amount IS NULL OR trim(amount) = '' THEN 'AMOUNT_MISSING;' ELSE '' END)
  || (CASE WHEN amount IS NOT NULL AND trim(amount) <> '' AND TRY_CAST(amount AS DECIMAL(38,9)) IS NULL THEN 'AMOUNT_NOT_NUMERIC;' ELSE '' END)
  || (CASE WHEN TRY_CAST(amount AS DECIMAL(38,9)) < 0 THEN 'AMOUNT_NEGATIVE;' ELSE '' END)"""


@query("validate_amount", oracle=f"""
SELECT page_id, amount, {AMOUNT_ERRORS_SQL} AS validation_errors, {AMOUNT_ERRORS_SQL} AS message, 'ERROR' AS severity,
       CAST(page_id AS VARCHAR) AS record_id, 'page_amounts' AS stage, 'run-2024-01-31' AS correlation_id
FROM {PAGE_AMOUNT_SQL}""")
def q_validate_amount(spark, sf):
    """Amounts with their codes and the structured error record of each."""
    checked = q.validate(page_amounts(Tables(spark, sf).pages), q.amount_rules("amount"))
    return q.error_record(checked, "page_id", "page_amounts", "run-2024-01-31").select("page_id", "amount", "validation_errors", "error.*")


# --- run health and error trends --------------------------------------------------------------------

@query("dq_health", oracle=f"""
WITH v AS (SELECT created_at AS ts, ({EVENT_ERRORS_SQL}) = '' AS ok FROM {WEB_SQL})
SELECT COUNT(*) FILTER (WHERE ok) AS processed, COUNT(*) FILTER (WHERE NOT ok) AS dead_lettered,
       round(COUNT(*) FILTER (WHERE NOT ok) / COUNT(*), 6) AS dlq_share,
       round(date_diff('second', MAX(ts) FILTER (WHERE ok), TIMESTAMP '2024-02-01 00:00:00') / 3600.0, 3) AS lag_hours,
       COUNT(*) FILTER (WHERE NOT ok) / COUNT(*) > 0.05 AS alert_dlq,
       date_diff('second', MAX(ts) FILTER (WHERE ok), TIMESTAMP '2024-02-01 00:00:00') / 3600.0 > 24.0 AS alert_stale
FROM v""")
def q_dq_health(spark, sf):
    """The health of a run, measured while its rows are written: the events are read once."""
    checked = q.validate(web_events(Tables(spark, sf).events), q.event_rules())
    measures = q.write_checked(checked, shared_dir(spark, "checked_events"), "created_at")
    return q.health_of(spark, measures, "2024-02-01 00:00:00")


@query("dq_consistency", oracle="""
WITH s AS (SELECT l_orderkey AS o_orderkey, CASE WHEN min(l_linestatus) = max(l_linestatus) THEN min(l_linestatus) ELSE 'P' END AS status
           FROM lineitem GROUP BY l_orderkey)
SELECT 'lines without order' AS check, COUNT(*) AS rows, COUNT(*) FILTER (l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS bad_rows FROM lineitem
UNION ALL SELECT 'orders without line', COUNT(*), COUNT(*) FILTER (o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) FROM orders
UNION ALL SELECT 'orders without customer', COUNT(*), COUNT(*) FILTER (o_custkey NOT IN (SELECT c_custkey FROM customer)) FROM orders
UNION ALL SELECT 'events without customer', COUNT(*), COUNT(*) FILTER (user_id NOT IN (SELECT c_custkey FROM customer)) FROM events
UNION ALL SELECT 'customers without order', COUNT(*), COUNT(*) FILTER (c_custkey NOT IN (SELECT o_custkey FROM orders)) FROM customer
UNION ALL SELECT 'status unlike lines', COUNT(*), COUNT(*) FILTER (o_orderstatus <> status) FROM orders JOIN s USING (o_orderkey)""")
def q_dq_consistency(spark, sf):
    """Consistency across tables: rows without their parent, orders whose status isn't that of their lines."""
    t = Tables(spark, sf)
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_linestatus").alias("a"), F.max("l_linestatus").alias("b"))
    lines = lines.select("o_orderkey", F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.lit("P")).alias("status"))
    return dd.union_all(
        q.orphans(t.lineitem, ["l_orderkey"], t.orders, ["o_orderkey"], "lines without order"),
        q.orphans(t.orders, ["o_orderkey"], t.lineitem, ["l_orderkey"], "orders without line"),
        q.orphans(t.orders, ["o_custkey"], t.customer, ["c_custkey"], "orders without customer"),
        q.orphans(t.events, ["user_id"], t.customer, ["c_custkey"], "events without customer"),
        q.orphans(t.customer, ["c_custkey"], t.orders, ["o_custkey"], "customers without order"),
        q.mismatches(t.orders, lines, ["o_orderkey"], "o_orderstatus", "status", "status unlike lines"))


def order_rules() -> list[q.Rule]:
    """Order checks used for the error-trend report."""
    return [
        q.Rule("TOTAL_NOT_POSITIVE", F.col("o_totalprice").isNull() | (F.col("o_totalprice") <= 0)),
        q.Rule("TOTAL_OUTLIER", F.col("o_totalprice") > 400000),
        q.Rule("STATUS_UNKNOWN", F.col("o_orderstatus").isNull() | ~F.col("o_orderstatus").isin("F", "O", "P")),
        q.Rule("PRIORITY_URGENT_PENDING", (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")),
    ]


ORDER_ERRORS_SQL = """
  (CASE WHEN o_totalprice IS NULL OR o_totalprice <= 0 THEN 'TOTAL_NOT_POSITIVE;' ELSE '' END)
  || (CASE WHEN o_totalprice > 400000 THEN 'TOTAL_OUTLIER;' ELSE '' END)
  || (CASE WHEN o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O', 'P') THEN 'STATUS_UNKNOWN;' ELSE '' END)
  || (CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN 'PRIORITY_URGENT_PENDING;' ELSE '' END)"""


@query("dq_error_delta", oracle=f"""
WITH e AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period_start, unnest(string_split({ORDER_ERRORS_SQL}, ';')) AS error_code FROM orders),
     c AS (SELECT period_start, error_code, COUNT(*) AS n_errors FROM e WHERE error_code <> '' GROUP BY 1, 2)
SELECT period_start, error_code, n_errors,
       n_errors - LAG(n_errors) OVER (PARTITION BY error_code ORDER BY period_start) AS delta FROM c""")
def q_dq_error_delta(spark, sf):
    _, dlq = q.split(q.validate(Tables(spark, sf).orders, order_rules()))
    return q.error_delta(dlq, "o_orderdate", "month")


@query("cast_reject", oracle=f"""
SELECT page_id, CAST(TRY_CAST(amount AS DECIMAL(38,9)) AS DOUBLE) AS amount_value,
       CASE WHEN amount IS NOT NULL AND TRY_CAST(amount AS DECIMAL(38,9)) IS NULL THEN 'amount;' ELSE '' END AS cast_errors
FROM {PAGE_AMOUNT_SQL}""")
def q_cast_reject(spark, sf):
    raw = page_amounts(Tables(spark, sf).pages)
    ok, rejects = files.cast_or_reject(raw, {"amount": "decimal(38,9)"})
    ok = ok.select("page_id", F.col("amount").cast("double").alias("amount_value"), F.lit("").alias("cast_errors"))
    return dd.union_all(ok, rejects.select("page_id", F.lit(None).cast("double").alias("amount_value"), "cast_errors"))

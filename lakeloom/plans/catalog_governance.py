"""Registered queries: governance (row/column policies, masking, PII discovery)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.operators import governance as gv
from lakeloom.plans.catalog_io import CUSTOMER_DAY_SQL, customer_day_from_events
from lakeloom.plans.registry import query
from lakeloom.plans.tables import Tables


@query("row_policy", oracle=f"SELECT * FROM ({CUSTOMER_DAY_SQL}) WHERE total_spent > 0")
def q_row_policy(spark, sf):
    gold = customer_day_from_events(Tables(spark, sf).events)
    policies = {"analysts": F.col("total_spent") > 0, "auditors": F.lit(True)}
    return gv.secured(gold, policies, ["analysts"])


@query("column_policy", oracle="SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def q_column_policy(spark, sf):
    return gv.visible_columns(Tables(spark, sf).customer, {"c_acctbal": ["finance"], "c_name": ["support", "finance"]},
                              ["support"])


def _pii_sql(col: str) -> str:
    out = col
    for name, pattern in gv.PII_DETECTORS.items():
        out = f"regexp_replace({out}, '{pattern}', '<{name}>', 'g')"
    return out


@query("mask_columns", oracle=f"SELECT doc_id, {_pii_sql('text')} AS text, sha256(source) AS source, lang FROM documents")
def q_mask_columns(spark, sf):
    d = Tables(spark, sf).documents.select("doc_id", "text", "source", "lang")
    return gv.mask(d, {"text": "pii", "source": "hash"}, ["support"], exempt_groups=["privacy_officers"])


def _discover_sql(cols):
    parts = []
    for c in cols:
        for k, pattern in gv.PII_DETECTORS.items():
            parts.append(f"""SELECT '{c}' AS column_name, '{k}' AS pii_class,
  COUNT(*) FILTER (WHERE regexp_matches({c}, '{pattern}')) AS hits, COUNT({c}) AS rows,
  CASE WHEN COUNT({c}) > 0 THEN COUNT(*) FILTER (WHERE regexp_matches({c}, '{pattern}')) / COUNT({c}) END AS hit_rate
FROM documents""")
    return "\nUNION ALL\n".join(parts)


@query("discover_pii", oracle=_discover_sql(["text", "lang", "source"]))
def q_discover_pii(spark, sf):
    return gv.discover_pii(Tables(spark, sf).documents, partitions=spark.sparkContext.defaultParallelism)

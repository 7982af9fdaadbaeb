"""Governance: row access policies, column visibility, dynamic masking and PII discovery.

All policies are plain projections/filters evaluated by Catalyst (row predicates are pushed
into the scan like any other filter); nothing is collected to decide what a user sees.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.columns import is_true
from lakeloom.session import spread

# fixed values: PII detectors (Java and RE2 read these patterns the same way)
PII_DETECTORS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "ipv4": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
    "us_ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "phone": r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}",
}


def secured(df: DataFrame, policies: Mapping[str, Column], principal_groups: Sequence[str]) -> DataFrame:
    """Row access policy (secured view): a principal sees the rows matching the predicate of
    any policy granted to one of its groups; with no granted policy it sees nothing."""
    preds = [p for group, p in policies.items() if group in set(principal_groups)]
    if not preds:
        return df.filter(F.lit(False))
    return df.filter(is_true(reduce(lambda a, b: a | b, preds)))


def visible_columns(df: DataFrame, column_policies: Mapping[str, Sequence[str]], principal_groups: Sequence[str]) -> DataFrame:
    """Column-level security: a column listed in ``column_policies`` is kept only when the
    principal belongs to one of its allowed groups; unlisted columns are public."""
    groups = set(principal_groups)
    keep = [c for c in df.columns if c not in column_policies or groups & set(column_policies[c])]
    return df.select(*keep)


def mask_expr(col: str, method: str, dtype: T.DataType) -> Column:
    c = F.col(col)
    if method == "hash":
        return F.sha2(c.cast("string"), 256)
    if method == "null":
        return F.lit(None).cast(dtype)
    if method == "redact":
        return F.when(c.isNull(), F.lit(None)).otherwise(F.lit("****")) if isinstance(dtype, T.StringType) \
            else F.lit(None).cast(dtype)
    if method == "last4":
        s = c.cast("string")
        return F.concat(F.repeat(F.lit("*"), F.greatest(F.length(s) - 4, F.lit(0))), F.substring(s, -4, 4))
    if method == "chars":
        return F.mask(c.cast("string"))
    if method == "pii":
        out = c.cast("string")
        for name, pattern in PII_DETECTORS.items():
            out = F.regexp_replace(out, pattern, f"<{name}>")
        return out
    raise ValueError(f"unknown mask method {method}")


def mask(df: DataFrame, methods: Mapping[str, str], principal_groups: Sequence[str] = (),
         exempt_groups: Sequence[str] = ()) -> DataFrame:
    """Dynamic masking: listed columns are masked unless the principal is in an exempt group."""
    if set(principal_groups) & set(exempt_groups):
        return df
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: mask_expr(c, m, types[c]) for c, m in methods.items()})


def discover_pii(df: DataFrame, detectors: Mapping[str, str] | None = None, columns: Sequence[str] | None = None,
                 sample_fraction: float | None = None, seed: int = 42, partitions: int | None = None) -> DataFrame:
    """Scan string columns for PII classes in ONE pass: a single aggregate of
    ``count_if(col rlike pattern)`` per (column, class), unpivoted to rows
    ``(column_name, pii_class, hits, rows, hit_rate)``. ``sample_fraction`` scans a
    Bernoulli sample instead of the whole table (the sampling option of a PII scanner). ``partitions`` deals
    the rows to that many tasks first (``session.spread``), for long texts in few files."""
    detectors = dict(detectors or PII_DETECTORS)
    cols = list(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])
    src = df.select(*cols)
    src = spread(src.sample(fraction=sample_fraction, seed=seed) if sample_fraction else src, partitions)
    aggs = []
    for c in cols:
        aggs.append(F.count(F.col(c)).alias(f"{c}||rows"))
        for k, pattern in detectors.items():
            aggs.append(F.count_if(F.col(c).rlike(pattern)).alias(f"{c}||{k}"))
    wide = src.agg(*aggs)
    rows = []
    for c in cols:
        for k in detectors:
            rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("pii_class"),
                                 F.col(f"`{c}||{k}`").alias("hits"), F.col(f"`{c}||rows`").alias("rows")))
    long = wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return long.withColumn("hit_rate", F.when(F.col("rows") > 0, F.col("hits") / F.col("rows")))

"""Column-level building blocks: projections, predicates and scalar helpers.

Everything here returns either a ``Column`` (JVM expression, stays inside whole-stage
codegen and is pushed into the Parquet scan when it is a simple comparison) or a
DataFrame produced by a single ``select``/``filter``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def c(x) -> Column:
    """Accept a column name or a Column."""
    return F.col(x) if isinstance(x, str) else x


def is_true(pred: Column) -> Column:
    """Three-valued predicate → two-valued: NULL counts as not true."""
    return F.coalesce(pred, F.lit(False))


# --- projections -------------------------------------------------------------------


def project(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Column subset with aliases: ``{new_name: old_name_or_expr}``."""
    return df.select(*[c(src).alias(new) for new, src in mapping.items()])


def with_const(df: DataFrame, name: str, value) -> DataFrame:
    """Literal column (``1 AS quantity``, empty error string, ...)."""
    return df.withColumn(name, F.lit(value))


def with_columns(df: DataFrame, mapping: Mapping[str, Column]) -> DataFrame:
    """Add or replace several columns in one projection."""
    return df.withColumns(dict(mapping))


def drop(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def except_rename(df: DataFrame, old: str, new: str) -> DataFrame:
    """``SELECT * EXCEPT (old), old AS new`` — the renamed column moves to the end."""
    return df.select(*[x for x in df.columns if x != old], F.col(old).alias(new))


def select_star(df: DataFrame, star_alias: str, others: Sequence[str | Column]) -> DataFrame:
    """``alias.*`` next to columns of the other join input."""
    return df.select(f"{star_alias}.*", *[c(o) for o in others])


def flatten(df: DataFrame, mapping: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Struct field access: ``{output_name: "a.b.c"}``."""
    return df.select(*keep, *[F.col(path).alias(name) for name, path in mapping.items()])


# --- predicates ----------------------------------------------------------------------


def require_not_null(df: DataFrame, *cols: str) -> DataFrame:
    pred = F.lit(True)
    for x in cols:
        pred = pred & F.col(x).isNotNull()
    return df.filter(pred)


def only_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def since(df: DataFrame, ts_col: str, now: str, interval: str, until: str | None = None) -> DataFrame:
    """Rows with ``ts >= now - interval`` (and optionally ``ts < until``).

    ``now`` is a parameter, never a hidden ``current_timestamp``: reruns are reproducible.
    The bound is constant-folded by Catalyst and reaches the Parquet scan as a pushed filter.
    """
    lower = F.expr(f"TIMESTAMP '{now}' - INTERVAL {interval}")
    ts = F.col(ts_col)
    if dict(df.dtypes).get(ts_col) == "timestamp_ntz":
        lower = lower.cast("timestamp_ntz")
    pred = ts >= lower
    if until is not None:
        upper = F.lit(until).cast(dict(df.dtypes).get(ts_col, "timestamp"))
        pred = pred & (ts < upper)
    return df.filter(pred)


def between(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Closed range ``lo <= col <= hi``."""
    return df.filter(F.col(col).between(lo, hi))


def in_list(col: str | Column, values: Iterable) -> Column:
    """Membership in a short literal list (kept as an ``In`` expression, pushed to the scan).

    For long lists use a left semi join: a join, not a giant literal.
    """
    return c(col).isin(list(values))


def ilike_any(col: str | Column, patterns: Iterable[str]) -> Column:
    """Case-insensitive LIKE against any of several patterns."""
    pred = F.lit(False)
    for p in patterns:
        pred = pred | c(col).ilike(p)
    return pred


def matches(col: str | Column, regex: str) -> Column:
    """Java-regex search (``rlike``); NULL input → NULL."""
    return c(col).rlike(regex)


def route(df: DataFrame, pred: Column) -> tuple[DataFrame, DataFrame]:
    """Split one input into two disjoint, complete outputs; a NULL predicate goes to 'no'."""
    flag = is_true(pred)
    return df.filter(flag), df.filter(~flag)


# --- scalars -------------------------------------------------------------------------


def safe_divide(num: Column, den: Column) -> Column:
    """SQL SAFE_DIVIDE: NULL when the divisor is 0 or NULL (for doubles too)."""
    return F.when(den == 0, F.lit(None)).otherwise(num / den)


def parse_timestamp(col: str | Column, formats: Sequence[str]) -> Column:
    """Standardise timestamps written in several formats: first format that parses wins."""
    return F.coalesce(*[F.try_to_timestamp(c(col), F.lit(f)) for f in formats])


def case_chain(branches: Sequence[tuple[Column, object]], default) -> Column:
    """Ordered CASE WHEN: the first matching branch wins."""
    expr = None
    for cond, value in branches:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return d if expr is None else expr.otherwise(d)


def to_money(col: str | Column, precision: int = 38, scale: int = 9) -> Column:
    """CAST AS NUMERIC — exact decimal arithmetic for money."""
    return c(col).cast(f"decimal({precision},{scale})")

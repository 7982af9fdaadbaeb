"""Registry of named queries (``key → (spark, sf_dir) → DataFrame``) and their SQL oracles.

Every registered query reads the driver's tables (or data Spark derives from them) in
full; the oracle is the same result written as plain SQL over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``key`` with an optional SQL oracle."""

    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return deco


def load_all() -> None:
    """Import every catalog module so their ``@query`` decorators run."""
    from lakeloom.plans import (  # noqa: F401
        catalog_governance,
        catalog_io,
        catalog_quality,
        catalog_relational,
        catalog_stream,
        catalog_tables,
        catalog_vector,
    )

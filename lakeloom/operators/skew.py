"""Skew handling: hot-key report, salted two-level aggregation and salted joins.

AQE splits skewed *join* partitions on its own, but not a hot group key feeding a
non-decomposable aggregate or a window. Salting spreads one key over ``salts`` tasks; the
result is always equal to the unsalted one (tests check it).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, key: str, n: int = 10, min_share: float = 0.0) -> DataFrame:
    """Keys with the largest row counts and their share of all rows.

    Per-key counts are a partial+final aggregate; the top ``n`` is a TakeOrderedAndProject
    (k rows per task). The total is a scalar aggregate, so no per-key data goes through the
    driver.
    """
    total = df.count()
    counts = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    out = counts.withColumn("share", F.col("n") / F.lit(float(max(total, 1))))
    if min_share > 0:
        out = out.filter(F.col("share") >= min_share)
    return out.orderBy(F.col("n").desc(), F.col("key")).limit(n)


#: Hot keys that may be broadcast; a longer list is joined.
BROADCAST_KEYS = 100_000


def _salt(df: DataFrame, salts: int, cols: Sequence[str] | None = None):
    cols = list(cols or df.columns)
    return F.pmod(F.xxhash64(*[F.col(x) for x in cols]), F.lit(salts)).cast("int")


def salted_sum(df: DataFrame, keys: Sequence[str], value: str, salts: int = 16, alias: str = "total") -> DataFrame:
    """SUM by keys in two levels: (keys, salt) then keys. A hot key is summed by ``salts``
    tasks in parallel before the final merge."""
    # salting on the columns in use keeps the scan as narrow as the plain sum's
    level1 = (df.select(*keys, value).withColumn("__salt", _salt(df, salts, [*keys, value]))
                .groupBy(*keys, "__salt").agg(F.sum(value).alias("__part")))
    return level1.groupBy(*keys).agg(F.sum("__part").alias(alias))


def salted_join(big: DataFrame, small: DataFrame, on: Sequence[str], salts: int = 8,
                hot_keys: DataFrame | None = None, how: str = "inner") -> DataFrame:
    """Equi-join where hot keys of ``big`` are spread over ``salts`` sub-keys.

    ``hot_keys`` (one column per join key) lists keys to salt; ``None`` salts every key.
    ``big`` rows get a deterministic salt from a hash of the row (stable under retries);
    ``small`` rows of salted keys are replicated once per salt value, so only joins that keep the
    big side's rows are right: inner, left, left_semi and left_anti. A short hot-key list is
    broadcast after its count; a long one is joined.
    """
    if how not in ("inner", "left", "left_outer", "leftouter", "left_semi", "leftsemi", "semi", "left_anti", "leftanti", "anti"):
        raise ValueError(f"a salted join replicates the small side: {how!r} would repeat its unmatched rows")
    on = list(on)
    row_salt = _salt(big, salts)
    if hot_keys is None:
        b = big.withColumn("__salt", row_salt)
        s = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    else:
        hk = hot_keys.select(*on).distinct().withColumn("__hot", F.lit(True))
        if hk.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
            hk = F.broadcast(hk)
        b = (big.join(hk, on=on, how="left")
                .withColumn("__salt", F.when(F.col("__hot"), row_salt).otherwise(F.lit(0))).drop("__hot"))
        s = (small.join(hk, on=on, how="left")
                  .withColumn("__salt", F.explode(F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
                                                  .otherwise(F.array(F.lit(0))))).drop("__hot"))
    return b.join(s, on=[*on, "__salt"], how=how).drop("__salt")


def skewed_keys(df: DataFrame, keys: Sequence[str], min_share: float = 0.01) -> DataFrame:
    """All keys (possibly composite) whose share of rows is at least ``min_share``; there are at
    most ``1 / min_share`` of them, so the list is bounded."""
    total = df.count()
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= F.lit(min_share * max(total, 1))).orderBy(F.col("n").desc(), *keys).select(*keys)

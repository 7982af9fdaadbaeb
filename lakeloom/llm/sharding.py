"""Sharding by jump consistent hashing (native: DataFrame functions only).

Lamping and Veach's jump hash maps a stable 64-bit key to one of ``n`` shards without a ring
table; with one shard more, a key either stays or moves into the new shard. The walk is an
``aggregate`` over at most ``n`` steps that does nothing once it has left the range (about
``ln n`` real steps); its 64-bit wrap-around product is a decimal(38) product modulo 2^64,
which stays exact under ANSI arithmetic.

Slots number a shard's rows from 0 without gaps in key order. They come from a count for
each (shard, key range), its running sum over the few ranges of a shard, and a row number
inside one (shard, key range), so no task ever holds a whole shard.

Defined results: a null key is treated as key -1 (it gets a shard, and the first slots);
equal keys share a shard and get consecutive slots by size and checksum; rows equal in all of
these are interchangeable. A null text has no bytes and checksum 0. An empty table gives an
empty result. Extra columns aren't read by ``assign`` and are kept by ``with_shard``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bytes counted for a row beside its text.
ROW_BYTES = 16
#: Multiplier of the published generator, and 2^64.
MULTIPLIER = "2862933555777941757"
TWO64 = "18446744073709551616"


def jump(key: Column, shards: int) -> Column:
    """The shard (int, 0 to ``shards`` - 1) of a bigint key."""
    if shards < 1:
        raise ValueError("shards must be positive")
    big = lambda x: (F.lit(x) if isinstance(x, str) else x).cast("decimal(38,0)")
    k = F.coalesce(key.cast("bigint"), F.lit(-1).cast("bigint"))
    start = F.struct(F.lit(-1).cast("bigint").alias("b"), F.lit(0).cast("bigint").alias("j"),
                     F.pmod(big(k), big(TWO64)).cast("decimal(38,0)").alias("k"))

    def step(a: Column, _: Column) -> Column:
        nxt = F.pmod((a["k"] * big(MULTIPLIER) + F.lit(1)).cast("decimal(38,0)"), big(TWO64)).cast("decimal(38,0)")
        high = ((nxt - F.pmod(nxt, big(str(1 << 33)))) / big(str(1 << 33))).cast("bigint") + 1
        far = F.floor((a["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / high.cast("double"))).cast("bigint")
        return F.when(a["j"] < shards, F.struct(a["j"].alias("b"), far.alias("j"), nxt.alias("k"))).otherwise(a)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda a: a["b"]).cast("int")


def with_shard(df: DataFrame, key: str, shards: int, name: str = "shard") -> DataFrame:
    """``df`` with the shard of each row, to be written with ``partitionBy(name)``."""
    return df.withColumn(name, jump(F.col(key), shards))


def key_ranges(df: DataFrame, key: str, ranges: int) -> list[int]:
    """At most ``ranges`` - 1 ascending cut points of the key (approximate quantiles; a bounded list)."""
    cuts = df.select(F.coalesce(F.col(key).cast("bigint"), F.lit(-1).cast("bigint")).cast("double").alias("k"))
    got = cuts.approxQuantile("k", [i / ranges for i in range(1, ranges)], 0.5 / ranges) if ranges > 1 else []
    return sorted({int(x) for x in got})


def assign(df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 40, ranges: int = 32) -> DataFrame:
    """One row per input row: key, size, text_crc32, law, shard, slot, grown_shard.

    ``ranges`` cuts each shard into that many key ranges for numbering; it changes the
    number of tasks, never the result.
    """
    rows = df.select(
        F.col(key).alias(key), F.coalesce(F.col(key).cast("bigint"), F.lit(-1).cast("bigint")).alias("_k"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).cast("bigint").alias("text_crc32"))
    at = F.lit(0)
    for cut in key_ranges(df, key, ranges):
        at = at + F.when(F.col("_k") >= F.lit(cut).cast("bigint"), 1).otherwise(0)
    rows = rows.select("*", jump(F.col("_k"), shards).alias("shard"), jump(F.col("_k"), shards + 1).alias("grown_shard"),
                       at.alias("_range"))
    counts = rows.groupBy("shard", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("shard", "_range").orderBy(F.col(key).isNotNull(), "_k", "size", "text_crc32")
    slot = F.row_number().over(inside) - 1 + F.col("_before")
    return rows.join(counts, ["shard", "_range"]).select(
        key, "size", "text_crc32", F.lit("key").alias("law"), "shard", slot.cast("bigint").alias("slot"), "grown_shard")


def moved(df: DataFrame, key: str, shards: int, more: int = 1) -> DataFrame:
    """The rows that move when ``more`` shards are appended, with ``shard`` and ``grown_shard``."""
    x = with_shard(with_shard(df, key, shards), key, shards + more, "grown_shard")
    return x.where(F.col("shard") != F.col("grown_shard"))

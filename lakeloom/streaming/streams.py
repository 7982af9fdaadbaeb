"""Structured Streaming: event-time windows, sessions, streaming dedupe, bronze landing and
validate-with-dead-letters per micro-batch.

Watermarks bound the state: windows and sessions are emitted (append mode) once the
watermark passes their end, and rows later than ``delay`` are dropped by Spark. Sinks are
files with checkpoints, so a restarted query resumes exactly where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators import quality


def as_event_time(sdf: DataFrame, ts: str) -> DataFrame:
    """``withWatermark`` needs TIMESTAMP (not TIMESTAMP_NTZ); the session zone is UTC."""
    if dict(sdf.dtypes).get(ts) == "timestamp_ntz":
        sdf = sdf.withColumn(ts, F.col(ts).cast("timestamp"))
    return sdf


def stream_windows(sdf: DataFrame, ts: str, size: str, slide: str | None = None, delay: str = "1 hour",
                   keys: Sequence[str] = (), value: str | None = None) -> DataFrame:
    """Tumbling (``slide=None``) or sliding event-time windows: count (and sum) per key."""
    sdf = as_event_time(sdf, ts).withWatermark(ts, delay)
    win = F.window(ts, size, slide) if slide else F.window(ts, size)
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        aggs.append(F.sum(F.col(value).cast("decimal(18,2)")).alias("total"))
    out = sdf.groupBy(win.alias("w"), *keys).agg(*aggs)
    measures = ["n", "total"] if value else ["n"]
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, *measures)


def stream_sessions(sdf: DataFrame, ts: str, keys: Sequence[str], gap: str, delay: str = "1 hour") -> DataFrame:
    """Session windows per key: a session closes after ``gap`` without events."""
    sdf = as_event_time(sdf, ts).withWatermark(ts, delay)
    out = sdf.groupBy(F.session_window(ts, gap).alias("s"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return out.select(*keys, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")


def stream_dedupe(sdf: DataFrame, keys: Sequence[str], ts: str, delay: str = "1 hour") -> DataFrame:
    """Drop rows whose key was already seen within the watermark delay."""
    return as_event_time(sdf, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def run_available(sdf: DataFrame, path: str, checkpoint: str, mode: str = "append", fmt: str = "parquet"):
    """Process everything available now into ``path`` and stop (restartable via checkpoint)."""
    q = (sdf.writeStream.format(fmt).outputMode(mode).option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def file_stream(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def stream_bronze(spark: SparkSession, src: str, schema, out: str, checkpoint: str, fmt: str = "parquet") -> DataFrame:
    """Land a clickstream into raw Parquet files; returns the landed table."""
    run_available(file_stream(spark, src, schema, fmt), out, checkpoint)
    return spark.read.schema(schema).parquet(out)


def stream_validate(sdf: DataFrame, rules: Sequence[quality.Rule], ok_path: str, dlq_path: str, checkpoint: str):
    """Validate each micro-batch and write clean rows and dead letters; other rows keep
    flowing when some fail. Writes are keyed by batch id (overwrite of ``batch_id=N``), so a
    batch replayed after a failure replaces its own output instead of duplicating it."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        checked = quality.validate(batch, rules)
        clean, dlq = quality.split(checked)
        clean.write.mode("overwrite").parquet(f"{ok_path}/batch_id={batch_id}")
        dlq.write.mode("overwrite").parquet(f"{dlq_path}/batch_id={batch_id}")

    q = (sdf.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
    q.awaitTermination()
    return q

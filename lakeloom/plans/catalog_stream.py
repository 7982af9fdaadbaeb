"""Registered queries: Structured Streaming over the driver's events landed as files.

Each query lands ``events`` as Parquet in the shared folder, runs a streaming query with an
``availableNow`` trigger into a file sink (with its own checkpoint), and returns the sink.
Append-mode windows are emitted only once the watermark (max event time − delay) passes
their end, so the oracles keep only closed windows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.operators import quality as q
from lakeloom.plans.catalog_quality import EVENT_ERRORS_SQL, WEB_SQL, web_events
from lakeloom.plans.registry import query
from lakeloom.plans.tables import Tables
from lakeloom.session import shared_dir
from lakeloom.streaming import streams as st

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


#: Micro-batches that a stream query reads at least.
BATCHES = 4


def _land(spark, sf, copies: int = 1) -> tuple[str, str]:
    """The events as files in order of time, read one a micro-batch: state lives on between batches.

    With several copies, each time range lands ``copies`` times in a row, so repeats come in later batches.
    """
    root = shared_dir(spark, "stream")
    e = Tables(spark, sf).events
    cuts = e.select(F.unix_micros(F.col("ts").cast("timestamp")).cast("double").alias("t")).approxQuantile(
        "t", [i / BATCHES for i in range(1, BATCHES)], 0.0001)
    part = F.lit(0)
    for c in cuts:
        part = part + F.when(F.unix_micros(F.col("ts").cast("timestamp")) >= F.lit(int(c)), 1).otherwise(0)
    e = e.withColumn("__part", part)
    for i in range(BATCHES):
        for k in range(copies):  # the file source takes the oldest files first
            e.filter(F.col("__part") == i).drop("__part").write.parquet(f"{root}/src/part={i}{k}")
    return root, f"{root}/src/part=*"


def _ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


WINDOW_ORACLE = """
SELECT time_bucket(INTERVAL '{size}', ts) AS window_start, time_bucket(INTERVAL '{size}', ts) + INTERVAL '{size}' AS window_end,
       event_type, COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM events GROUP BY 1, 2, 3
HAVING time_bucket(INTERVAL '{size}', ts) + INTERVAL '{size}' <= (SELECT MAX(ts) FROM events) - INTERVAL '{delay}'"""


@query("stream_tumbling", oracle=WINDOW_ORACLE.format(size="1 day", delay="1 hour"))
def q_stream_tumbling(spark, sf):
    root, src = _land(spark, sf)
    sdf = st.file_stream(spark, src, EVENTS_SCHEMA, max_files_per_trigger=1)
    out = st.stream_windows(sdf, "ts", "1 day", None, "1 hour", ["event_type"], "value")
    st.run_available(out, f"{root}/out", f"{root}/chk")
    res = spark.read.parquet(f"{root}/out")
    return _ntz(res, "window_start", "window_end").withColumn("total", F.col("total").cast("double"))


SLIDING_ORACLE = """
WITH w AS (SELECT ts, event_type, value, unnest([time_bucket(INTERVAL '1 day', ts), time_bucket(INTERVAL '1 day', ts - INTERVAL '12 hours') + INTERVAL '12 hours']) AS window_start FROM events)
SELECT window_start, window_end, event_type, n FROM (
  SELECT window_start, window_start + INTERVAL '1 day' AS window_end, event_type, COUNT(*) AS n FROM w
  WHERE ts >= window_start AND ts < window_start + INTERVAL '1 day' GROUP BY 1, 2, 3)
WHERE window_end <= (SELECT MAX(ts) FROM events) - INTERVAL '1 hour'"""


@query("stream_sliding", oracle=SLIDING_ORACLE)
def q_stream_sliding(spark, sf):
    root, src = _land(spark, sf)
    sdf = st.file_stream(spark, src, EVENTS_SCHEMA, max_files_per_trigger=1)
    out = st.stream_windows(sdf, "ts", "1 day", "12 hours", "1 hour", ["event_type"])
    st.run_available(out, f"{root}/out", f"{root}/chk")
    return _ntz(spark.read.parquet(f"{root}/out"), "window_start", "window_end")


SESSION_ORACLE = """
WITH g AS (SELECT user_id, ts, CASE WHEN ts - LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL '2 hours' THEN 0 ELSE 1 END AS new_s FROM events),
     s AS (SELECT user_id, ts, SUM(new_s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g),
     a AS (SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL '2 hours' AS session_end, COUNT(*) AS n FROM s GROUP BY user_id, sid)
SELECT * FROM a WHERE session_end <= (SELECT MAX(ts) FROM events) - INTERVAL '1 hour'"""


@query("stream_session", oracle=SESSION_ORACLE)
def q_stream_session(spark, sf):
    root, src = _land(spark, sf)
    sdf = st.file_stream(spark, src, EVENTS_SCHEMA, max_files_per_trigger=1)
    out = st.stream_sessions(sdf, "ts", ["user_id"], "2 hours", "1 hour")
    st.run_available(out, f"{root}/out", f"{root}/chk")
    return _ntz(spark.read.parquet(f"{root}/out"), "session_start", "session_end")


@query("stream_dedupe", oracle="SELECT * FROM events")
def q_stream_dedupe(spark, sf):
    root, src = _land(spark, sf, copies=2)
    sdf = st.file_stream(spark, src, EVENTS_SCHEMA, max_files_per_trigger=1)
    out = st.stream_dedupe(sdf, ["event_id"], "ts", "1 hour")
    st.run_available(out, f"{root}/out", f"{root}/chk")
    return _ntz(spark.read.parquet(f"{root}/out"), "ts").select("event_id", "ts", "user_id", "event_type", "value", "props")


@query("stream_bronze", oracle="SELECT * FROM events")
def q_stream_bronze(spark, sf):
    root, src = _land(spark, sf)
    return st.stream_bronze(spark, src, EVENTS_SCHEMA, f"{root}/bronze", f"{root}/chk")


@query("stream_validate", oracle=f"""
SELECT id, user_id, event_type FROM {WEB_SQL} WHERE ({EVENT_ERRORS_SQL}) = ''""")
def q_stream_validate(spark, sf):
    root, src = _land(spark, sf)
    sdf = web_events(st.file_stream(spark, src, EVENTS_SCHEMA, max_files_per_trigger=1))
    st.stream_validate(sdf, q.event_rules(), f"{root}/ok", f"{root}/dlq", f"{root}/chk")
    return spark.read.parquet(f"{root}/ok").select("id", "user_id", "event_type")

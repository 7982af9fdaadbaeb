"""Writers: replace / append / overwrite tables, partitioned + clustered CTAS, typed CTAS at a
location, dead-letter outputs, bronze landing and temp views.

Idempotency: every writer either replaces what it owns (table, run-date partition) or is
explicitly an append; re-running a job with the same inputs gives the same table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.session import conf_set, delete_path


def replace_table(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """CREATE OR REPLACE TABLE name AS <df>; returns the table."""
    w = df.write.mode("overwrite").format(fmt)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def append_table(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Append rows (not idempotent by design; prefer ``tables.upsert`` for keyed data)."""
    w = df.write.mode("append").format(fmt)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def overwrite_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    return replace_table(df, name, path)


def rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` gathered by ``columns`` for writing; AQE splits large and joins small partitions."""
    return df.hint("rebalance", *[F.col(c) for c in columns])


def write_partitioned(df: DataFrame, name: str, partition_by: Sequence[str], cluster_by: Sequence[str] = (),
                      path: str | None = None) -> DataFrame:
    """CTAS ... PARTITION BY p CLUSTER BY k.

    A REBALANCE on the partition columns gathers each value's rows in few writer tasks and lets
    AQE split a value that is too large for one; ``sortWithinPartitions(k)`` lays rows out by
    the cluster key so Parquet row-group min/max statistics can skip blocks. The whole table is
    replaced: partitions that ``df`` lacks go.
    """
    out = rebalanced(df, *partition_by)
    if cluster_by:
        out = out.sortWithinPartitions(*partition_by, *cluster_by)
    w = out.write.mode("overwrite").partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    # as a writer option it would stay with the table and rule its later inserts too
    with conf_set(df.sparkSession, "spark.sql.sources.partitionOverwriteMode", "static"):
        w.saveAsTable(name)
    return df.sparkSession.table(name)


def write_typed(df: DataFrame, name: str, schema: Mapping[str, str], path: str) -> DataFrame:
    """CTAS with declared column types into an open-format table at ``path``."""
    typed = df.select(*[F.col(k).cast(v).alias(k) for k, v in schema.items()])
    typed.write.mode("overwrite").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def write_dlq(df: DataFrame, root: str, run_date: str, fmt: str = "json") -> bool:
    """Dead-letter output for one run date; a rerun replaces it, also when nothing is left to write.

    Emptiness is checked with ``isEmpty()`` (stops at the first row) rather than ``count()``.
    Other run dates are never touched, whatever the session's overwrite mode. Returns whether rows were written.
    """
    if df.isEmpty():
        delete_path(df.sparkSession, f"{root}/run_date={run_date}")
        return False
    out = df.withColumn("run_date", F.lit(run_date))
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date")
    w = w.option("header", True) if fmt == "csv" else w.options(**JSON_TS_OPTIONS) if fmt == "json" else w
    w.format(fmt).save(root)
    return True


def write_dlq_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    return replace_table(df, name, path)


def land_bronze(df: DataFrame, root: str, key: str, run_date: str, fmt: str = "json") -> None:
    """Land raw records by ``key`` and run date; a rerun replaces the same run's files only
    (dynamic partition overwrite on ``(key, run_date)``)."""
    w = (rebalanced(df.withColumn("run_date", F.lit(run_date)), key)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key, "run_date").format(fmt))
    if fmt == "json":
        w = w.options(**JSON_TS_OPTIONS)
    w.save(root)


# JSON keeps full microsecond precision (Spark's default text format stops at milliseconds)
JSON_TS_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def register(df: DataFrame, view_name: str) -> DataFrame:
    """Named intermediate relation (temp view); returns the view."""
    df.createOrReplaceTempView(view_name)
    return df.sparkSession.table(view_name)

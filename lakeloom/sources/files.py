"""Readers: CSV, NDJSON, catalog tables, generic file→table loads, suffix ranges, JDBC,
corrupt-row and cast-failure routing.

Bronze is schema-on-read with an explicit schema wherever one is known (inference costs a
full extra pass over the files and guesses types per file).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.session import cut_lineage

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
             header: bool = True, **options) -> DataFrame:
    """CSV with a header; infers types only when no schema is given."""
    r = spark.read.option("header", header)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True)
    for k, v in options.items():
        r = r.option(k, v)
    return r.csv(path)


def read_ndjson(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
                base_path: str | None = None) -> DataFrame:
    """Newline-delimited JSON over a path or glob (``bronze/*/2025-01-02.json``).

    ``base_path`` makes the ``key=value`` folders below it columns again (a glob alone
    would drop them).
    """
    from lakeloom.sources.sinks import JSON_TS_OPTIONS

    r = spark.read.options(**JSON_TS_OPTIONS)
    if schema is not None:
        r = r.schema(schema)
    if base_path:
        r = r.option("basePath", base_path)
    return r.json(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def load_files(spark: SparkSession, fmt: str, location: str | Sequence[str], table: str | None = None,
               mode: str = "overwrite", infer: bool = True, path: str | None = None,
               schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Parameterised file → table job (format, location, inference, table, write mode).

    Returns the loaded DataFrame; when ``table`` is given it is also saved (at ``path`` when
    given, making it an external table).
    """
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    elif fmt in ("csv",):
        r = r.option("header", True).option("inferSchema", infer)
    for k, v in options.items():
        r = r.option(k, v)
    df = r.load(location)
    if table:
        w = df.write.mode(mode)
        if path:
            w = w.option("path", path)
        w.saveAsTable(table)
        return spark.table(table)
    return df


def load_csv(spark: SparkSession, paths: str | Sequence[str], table: str, schema: T.StructType | str,
             skip_rows: int = 1, mode: str = "overwrite", path: str | None = None) -> DataFrame:
    """LOAD DATA OVERWRITE table FROM FILES (CSV, skip leading rows).

    ``skip_rows=1`` is the header line; more leading rows are dropped by their position in
    each file (``_metadata.row_index`` is not exposed for CSV, so only the header is
    supported natively).
    """
    if skip_rows not in (0, 1):
        raise ValueError("only a single header row can be skipped")
    df = spark.read.option("header", skip_rows == 1).schema(schema).csv(paths)
    w = df.write.mode(mode)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
    return spark.table(table)


def read_suffix_range(spark: SparkSession, root: str, lo: str, hi: str, column: str = "suffix",
                      fmt: str = "parquet") -> DataFrame:
    """Wildcard tables restricted by a name-suffix range (``events_20240105`` ..).

    The suffix is laid out as a partition column (``root/suffix=20240105/``) so the closed
    range prunes partitions before any file is opened.
    """
    df = spark.read.format(fmt).option("basePath", root).load(root)
    return df.filter(F.col(column).cast("string").between(lo, hi))


def read_federated(spark: SparkSession, url: str, query: str, driver: str | None = None,
                   properties: Mapping[str, str] | None = None, num_partitions: int | None = None,
                   partition_column: str | None = None, lower: int | None = None,
                   upper: int | None = None) -> DataFrame:
    """Run a query in an external database and use its result as a relation (JDBC).

    With a numeric ``partition_column`` and bounds the read is split into ``num_partitions``
    range queries so it is not pulled through one connection.
    """
    r = spark.read.format("jdbc").option("url", url)
    if driver:
        r = r.option("driver", driver)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("dbtable", f"({query}) q").option("partitionColumn", partition_column)
             .option("lowerBound", lower).option("upperBound", upper).option("numPartitions", num_partitions or 8))
    else:
        r = r.option("query", query)
    return r.load()


def read_with_rejects(spark: SparkSession, fmt: str, path: str | Sequence[str], schema: T.StructType,
                      **options) -> tuple[DataFrame, DataFrame]:
    """(ok, rejects): rows that fail parsing land in the rejects frame with their raw text.

    JSON lines are read as text and parsed by ``from_json`` with a corrupt-record column, so both
    frames are plain filters over one scan. Other formats use the reader's own PERMISSIVE mode,
    whose frame is stored first: Spark refuses queries of the corrupt column alone off a file scan.
    """
    full = schema.add(T.StructField(CORRUPT, T.StringType(), True)) if CORRUPT not in schema.fieldNames() else schema
    if fmt == "json" and not options:
        how = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        lines = spark.read.text(path).filter(F.trim("value") != "").select("value", F.from_json("value", full, how).alias("row"))
        bad = F.col("row").isNull() | F.col(f"row.{CORRUPT}").isNotNull()
        names = [f.name for f in full.fields if f.name != CORRUPT]
        return (lines.filter(~bad).select(*[F.col("row")[c].alias(c) for c in names]),
                lines.filter(bad).select(F.col("value").alias("raw_record")))
    r = spark.read.format(fmt).schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    for k, v in options.items():
        r = r.option(k, v)
    parsed = r.load(path)
    # Spark disallows filtering on the corrupt column straight off the scan; a checkpoint
    # (lineage cut in the shared checkpoint folder, survives executor loss) gives a
    # materialised relation that both branches read.
    parsed = cut_lineage(parsed)
    ok = parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    rejects = parsed.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("raw_record"))
    return ok, rejects


def cast_or_reject(df: DataFrame, types: Mapping[str, str], id_cols: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(ok, rejects): ``try_cast`` each column; a row with any value that is non-NULL before
    and NULL after the cast is rejected with the failing column names."""
    casted = df.withColumns({f"__c_{k}": F.col(k).try_cast(v) for k, v in types.items()})
    failed = F.concat(*[F.when(F.col(k).isNotNull() & F.col(f"__c_{k}").isNull(), F.lit(f"{k};")).otherwise(F.lit(""))
                        for k in types])
    casted = casted.withColumn("cast_errors", failed)
    ok = (casted.filter(F.col("cast_errors") == "")
                .withColumns({k: F.col(f"__c_{k}") for k in types})
                .drop(*[f"__c_{k}" for k in types], "cast_errors"))
    rejects = casted.filter(F.col("cast_errors") != "").drop(*[f"__c_{k}" for k in types])
    return ok, rejects


def inline(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str) -> DataFrame:
    """Literal rows with a declared schema (fixtures, golden tests)."""
    return spark.createDataFrame(list(rows), schema)


def gen_weblog(spark: SparkSession, n: int = 5000, seed: int = 42, customers: int = 500) -> DataFrame:
    """Seeded synthetic web log (distribution-equal to the sample generator, not bit-equal).

    customer 1..500, log id 0..n-1, timestamp 2025-01-01 + 0..200000 minutes, one of 5 URLs,
    ~30 % of rows with a purchase amount in 0..200 (2 decimals), otherwise 0.
    """
    # fixed values: the five URLs of the sample web log
    urls = F.array(*[F.lit(u) for u in ["/home", "/product/1", "/product/2", "/cart", "/checkout"]])
    base = spark.range(n).withColumnRenamed("id", "log_id")
    return base.select(
        (F.floor(F.rand(seed) * customers) + 1).cast("bigint").alias("customer_id"),
        "log_id",
        F.date_format(F.timestamp_seconds(F.unix_timestamp(F.lit("2025-01-01 00:00:00"))
                                          + F.floor(F.rand(seed + 1) * 200001) * 60), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.element_at(urls, (F.floor(F.rand(seed + 2) * 5) + 1).cast("int")).alias("url"),
        F.when(F.rand(seed + 3) < 0.3, F.round(F.rand(seed + 4) * 200, 2)).otherwise(F.lit(0.0)).alias("purchase_amount"),
    )

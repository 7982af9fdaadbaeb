"""Table changes on Parquet tables: MERGE / UPSERT / UPDATE / DELETE, schema evolution,
time-travel-like reads and derived partitions.

Parquet tables have no MERGE/UPDATE/DELETE, so each change is a DataFrame expression
(``target ⋈ source`` anti-join + union, CASE backfill, keep-filter). :func:`rewrite_partitions`
then writes it back with dynamic partition overwrite, so only the touched partitions are
replaced; unpartitioned tables are written to a fresh snapshot folder (see ``sources.sinks``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.functions.columns import case_chain, is_true
from lakeloom.operators.dedupe import dedupe_latest
from lakeloom.operators.marts import latest_agg
from lakeloom.session import conf_set, cut_lineage, delete_path
from lakeloom.sources.sinks import rebalanced


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None,
           update_cols: Sequence[str] | None = None) -> DataFrame:
    """MERGE as one full outer join on the keys: each side is read once.

    A matched key takes the source's ``update_cols`` (default: all but the keys) and keeps the
    target's other columns; unmatched source rows are inserted, other target rows kept. The
    source is reduced to one row a key by ``order`` when given; without it, a key that comes
    twice fails the job (a MERGE must not pick one silently).
    """
    rest = [x for x in target.columns if x not in keys]
    update = rest if update_cols is None else list(update_cols)
    if set(update) - set(rest):
        raise ValueError(f"not columns of the target: {sorted(set(update) - set(rest))}")
    src = source.select(*target.columns, *[o for o in order or () if o not in target.columns])
    if order:
        src = latest_agg(src, keys, order).select(*target.columns)
    else:
        row = F.struct(*[F.col(x) for x in rest], F.lit(1).alias("__n"))
        unique = F.when(F.count(F.lit(1)) == 1, F.first(row)).otherwise(
            F.raise_error(F.lit("the source of a MERGE holds a key more than once")))
        src = src.groupBy(*keys).agg(unique.alias("__row")).select(*keys, *[F.col("__row")[x].alias(x) for x in rest])
    t = target.select(*keys, F.struct(*[F.col(x) for x in rest], F.lit(1).alias("__n")).alias("__t"))
    s = src.select(*keys, F.struct(*[F.col(x) for x in rest], F.lit(1).alias("__n")).alias("__s"))
    new, old = F.col("__s").isNotNull(), F.col("__t").isNotNull()
    out = [F.when(new if x in update else new & ~old, F.col("__s")[x]).otherwise(F.col("__t")[x]).alias(x) for x in rest]
    joined = t.join(s, on=list(keys), how="full_outer").select(*keys, *out)
    return joined.select(*target.columns)


def upsert_partitions(spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str], partition_col: str,
                      order: Sequence[str] | None = None) -> DataFrame:
    """UPSERT into a partitioned table, rewriting only the partitions the source touches.

    The target is read through a semi-join on the touched partition values (dynamic partition
    pruning skips every other partition), merged with :func:`upsert`, materialised in the
    shared checkpoint folder (the table is rewritten from itself) and written back with
    dynamic partition overwrite. ``partition_col`` must be one of ``keys`` (typically a
    column derived from another key, e.g. the month of a date) so a key never moves between
    partitions. Returns the source rows with a NULL key: they match nothing, so they are the
    caller's dead letters, and rows stored under a NULL partition are never rewritten.
    """
    if partition_col not in keys:
        raise ValueError("the partition column must be one of the merge keys")
    source, rejects = split_null_keys(source, keys)
    touched = source.select(partition_col).distinct()
    current = spark.table(table).join(touched, partition_col, "left_semi")
    merged = upsert(current, source, keys, order)
    rewrite_partitions(cut_lineage(merged), table)
    return rejects


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with all keys, rows with a NULL key)."""
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    return df.filter(~null_key), df.filter(null_key)


def merge_insert(target: DataFrame, staged: DataFrame, keys: Sequence[str], ts: str,
                 tiebreak: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Insert-only MERGE: newest staged row per key, inserted only for keys the target lacks.

    Returns ``(result, rejects)``: staged rows with a NULL key are dead-lettered instead of
    being re-inserted on every run (defect D11).
    """
    new_rows, rejects = rows_to_insert(target, staged, keys, ts, tiebreak)
    return target.unionByName(new_rows), rejects


def rows_to_insert(target: DataFrame, staged: DataFrame, keys: Sequence[str], ts: str,
                   tiebreak: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(newest staged row of each key that the target lacks, rows with a NULL key): append the first to a stored table."""
    staged, rejects = split_null_keys(staged, keys)
    fresh = dedupe_latest(staged, keys, ts, tiebreak)
    return fresh.join(target.select(*keys), on=list(keys), how="left_anti").select(*target.columns), rejects


def backfill_case(df: DataFrame, target: str, branches: Sequence[tuple[Column, object]], default) -> DataFrame:
    """UPDATE t SET target = CASE ... END WHERE target IS NULL — as one projection.

    Branch order matters (first match wins); existing non-NULL values are kept.
    """
    if target not in df.columns:
        df = df.withColumn(target, F.lit(None).cast("string"))
    return df.withColumn(target, F.coalesce(F.col(target), case_chain(branches, default)))


# fixed values: browser agent → operating system, first match wins
OS_PATTERNS = [
    ("iOS", ["%iPhone%", "%iPad%", "%iOS%"]),
    ("Android", ["%Android%"]),
    ("Mac", ["%Mac OS X%", "%Macintosh%"]),
    ("Windows", ["%Windows NT%"]),
]
OS_DEFAULT = "Other/Unknown"


def os_branches(col: str) -> list[tuple[Column, str]]:
    out = []
    for name, pats in OS_PATTERNS:
        pred = F.lit(False)
        for p in pats:
            pred = pred | F.col(col).ilike(p)
        out.append((is_true(pred), name))
    return out


def add_column(spark: SparkSession, table: str, name: str, dtype: str, comment: str | None = None) -> bool:
    """ALTER TABLE ADD COLUMN, skipped when the column exists (re-runnable — defect D12)."""
    if name.lower() in [x.lower() for x in spark.table(table).columns]:
        return False
    cmt = f" COMMENT '{comment}'" if comment else ""
    spark.sql(f"ALTER TABLE {table} ADD COLUMN {name} {dtype}{cmt}")
    return True


def read_merged(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read files with differing additive schemas as one table (missing columns → NULL)."""
    return spark.read.format(fmt).option("mergeSchema", "true").load(path)


def as_of(history: DataFrame, keys: Sequence[str], ts: str, t: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """State of a keyed change history at time ``t``: newest version per key with ``ts <= t``."""
    bound = F.lit(t).cast(dict(history.dtypes)[ts])
    return dedupe_latest(history.filter(F.col(ts) <= bound), keys, ts, tiebreak)


#: Closing period of versions that still hold.
OPEN = "9999-12-31"


def store_versions(history: DataFrame, keys: Sequence[str], ts: str, path: str, tiebreak: Sequence[str] = (), grain: str = "month") -> None:
    """Writes a keyed change history as validity intervals, partitioned by the period in which a version ended.

    ``valid_from`` is the version's time, ``valid_to`` that of the next one (null: still valid). Of versions at one time
    the last by ``tiebreak`` stays.
    """
    nxt = F.lead(ts).over(Window.partitionBy(*keys).orderBy(ts, *tiebreak))
    rows = history.withColumns({"valid_from": F.col(ts), "valid_to": nxt}).where("valid_to IS NULL OR valid_to > valid_from")
    rows = rows.withColumn("closed", F.coalesce(F.trunc(F.to_date("valid_to"), grain), F.lit(OPEN).cast("date")))
    rebalanced(rows, "closed").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("closed").parquet(path)


def stored_as_of(spark: SparkSession, path: str, t: str, grain: str = "month") -> DataFrame:
    """State at time ``t`` of a history stored by :func:`store_versions`; periods that closed before ``t`` aren't read."""
    rows = spark.read.parquet(path)
    bound = F.lit(t).cast(dict(rows.dtypes)["valid_from"])
    inside = (F.col("valid_from") <= bound) & (F.col("valid_to").isNull() | (F.col("valid_to") > bound))
    return rows.where((F.col("closed") >= F.trunc(F.to_date(F.lit(t)), grain)) & inside).drop("valid_from", "valid_to", "closed")


def with_partition(df: DataFrame, ts: str, grain: str = "day", name: str | None = None) -> DataFrame:
    """Derived partition column (hidden partitioning re-aimed): ``to_date`` / ``trunc``."""
    name = name or f"{ts}_{grain}"
    if grain == "day":
        return df.withColumn(name, F.to_date(F.col(ts)))
    if grain in ("month", "year"):
        return df.withColumn(name, F.trunc(F.to_date(F.col(ts)), grain))
    if grain == "hour":
        return df.withColumn(name, F.date_trunc("hour", F.col(ts)))
    raise ValueError(grain)


def prune(df: DataFrame, ts: str, lo: str, hi: str, grain: str = "day", name: str | None = None) -> DataFrame:
    """Filter on BOTH the raw column and its derived partition column, so a table written with
    ``partitionBy(name)`` is pruned to the partitions in range and rows are exact within them."""
    name = name or f"{ts}_{grain}"
    ttype = dict(df.dtypes)[ts]
    pred = (F.col(ts) >= F.lit(lo).cast(ttype)) & (F.col(ts) < F.lit(hi).cast(ttype))
    if name in df.columns:
        pred = pred & (F.col(name) >= F.to_date(F.lit(lo))) & (F.col(name) <= F.to_date(F.lit(hi)))
    return df.filter(pred)


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """DELETE WHERE p ≡ keep rows where p is not TRUE (a NULL predicate keeps the row)."""
    return df.filter(~is_true(predicate))


def rewrite_partitions(df: DataFrame, table: str) -> None:
    """Write back only the partitions present in ``df`` (dynamic partition overwrite).

    Works while ``df`` reads ``table`` because ``insertInto`` stages new files before it
    replaces each touched partition. A REBALANCE gathers each partition's rows; AQE splits a large one.
    """
    spark = df.sparkSession
    parts = partition_columns(spark, table)
    out = df.select(*spark.table(table).columns)
    if parts:
        out = rebalanced(out, *parts)
    with conf_set(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        out.write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def delete_from(spark: SparkSession, table: str, predicate: Column) -> None:
    """DELETE FROM a stored table: partitions with a matching row are rewritten, emptied ones removed.

    An unpartitioned table is rewritten whole.
    """
    current, parts = spark.table(table), partition_columns(spark, table)
    if not parts:
        rewrite_partitions(cut_lineage(delete_where(current, predicate)), table)
        return
    same = lambda a, b: [F.col(f"{a}.{p}").eqNullSafe(F.col(f"{b}.{p}")) for p in parts]
    touched = cut_lineage(current.filter(is_true(predicate)).select(*parts).distinct())
    kept = current.alias("t").join(touched.alias("d"), same("t", "d"), "left_semi")
    kept = cut_lineage(delete_where(kept, predicate))
    rewrite_partitions(kept, table)
    left = kept.select(*parts).distinct()
    for row in touched.alias("d").join(left.alias("l"), same("d", "l"), "left_anti").collect():  # one row an emptied partition
        spec = ", ".join(f"{p} = {_literal(row[p])}" for p in parts)
        if not spark.sql(f"SHOW PARTITIONS {table} PARTITION ({spec})").take(1):
            continue
        place = spark.sql(f"DESCRIBE EXTENDED {table} PARTITION ({spec})").filter("col_name = 'Location'").first()["data_type"]
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
        delete_path(spark, place)  # an external table keeps the files of a dropped partition
    spark.catalog.refreshTable(table)


def _literal(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def update_where(spark: SparkSession, table: str, values: dict[str, Column], predicate: Column) -> None:
    """UPDATE a stored table: rows where ``predicate`` is TRUE take ``values``; untouched partitions keep their files.

    Partition columns can't be updated: a row would have to move.
    """
    current, parts = spark.table(table), partition_columns(spark, table)
    if set(values) & set(parts):
        raise ValueError("a partition column can't be updated")
    hit = is_true(predicate)
    if parts:
        touched = cut_lineage(current.filter(hit).select(*parts).distinct())
        current = current.alias("t").join(touched.alias("d"), [F.col(f"t.{p}").eqNullSafe(F.col(f"d.{p}")) for p in parts], "left_semi")
    changed = current.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()})
    rewrite_partitions(cut_lineage(changed), table)

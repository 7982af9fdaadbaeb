"""Joins, aggregates, windows and top-k — the gold-layer ("mart") operators.

Design notes for scale:
* aggregates are native (partial aggregate per task + one Exchange + final aggregate);
* per-group top-k is ``row_number() <= k`` which Spark plans as a *partial*
  ``WindowGroupLimit`` before the shuffle, so a hot group ships at most k rows per task;
* "latest per key" is a ``max_by(struct, order)`` aggregate, not a window: a key holding a
  third of all rows is collapsed map-side instead of landing in one sort task;
* row numbers of a key with very many rows are counted by several tasks: ranges of the order, counts, offsets;
* time-series windows (LAG, moving averages) run over per-(key, day) bars whose size per key
  is bounded by the number of days, or over segments of a key that carry the rows before them along.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions.columns import c, safe_divide, since
from lakeloom.session import stored

# --- joins -------------------------------------------------------------------------------


def join_recent(orders: DataFrame, items: DataFrame, key: str, ts_col: str, now: str, interval: str,
                until: str | None = None) -> DataFrame:
    """Orders ⋈ items on ``key`` for orders since ``now - interval``.

    The time filter is applied to the orders side before the join so it reaches the scan as a
    pushed filter; Catalyst/AQE choose broadcast vs sort-merge from measured sizes.
    """
    recent = since(orders, ts_col, now, interval, until)
    return recent.join(items, on=key, how="inner")


def enrich(facts: DataFrame, dim: DataFrame, left_on: str, right_on: str, dim_cols: Sequence[str],
           order: Sequence[str], n: int) -> DataFrame:
    """``facts ⋈ dim`` keeping all fact columns plus chosen dimension columns, ordered and limited.

    ``orderBy().limit(n)`` is planned as ``TakeOrderedAndProject`` (per-task top-n, then merge).
    """
    j = facts.alias("fact").join(dim.alias("dim"), F.col(f"fact.{left_on}") == F.col(f"dim.{right_on}"), "inner")
    out = j.select("fact.*", *[F.col(f"dim.{x}") for x in dim_cols])
    return out.orderBy(*[c(o) for o in order]).limit(n)


#: Values that a list holds at most; a larger group has several lists.
LIST_VALUES = 100_000


def value_lists(df: DataFrame, keys: Sequence[str], value: str, alias: str, most: int = LIST_VALUES) -> DataFrame:
    """``keys, chunk_no, alias``: all values of a key in sorted lists of ``most`` values, the last one shorter.

    Keys with more than ``most`` rows are numbered (:func:`row_rank`, by several tasks) and cut by these numbers, so equal
    values are dealt to several lists too; the lists of a key follow one another in order. Other keys are one list, number 0.
    """
    rows = df.select(*keys, F.col(value).alias("__v"))
    large = stored(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > most), "large-keys")
    if large.isEmpty():
        dealt = rows.withColumn("chunk_no", F.lit(0).cast("bigint"))
    else:
        some, rest = _of_keys(rows, large, keys)
        numbered = row_rank(some, keys, [F.col("__v")], "__at")
        dealt = numbered.withColumn("chunk_no", F.floor((F.col("__at") - 1) / most)).drop("__at").unionByName(
            rest.withColumn("chunk_no", F.lit(0).cast("bigint")))
    return dealt.groupBy(*keys, "chunk_no").agg(F.array_sort(F.collect_list("__v")).alias(alias))


def _of_keys(df: DataFrame, some: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``df`` split into the rows whose keys are in ``some`` (nulls match) and the others."""
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"l.{k}")) for k in keys]
    join = lambda how: df.alias("r").join(some.select(*keys).alias("l"), same, how)
    return join("left_semi"), join("left_anti")


def cogroup(left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str,
            most: int = LIST_VALUES) -> DataFrame:
    """Multi-input key join keeping each side's values (CoGroupByKey): ``key, chunk_no`` and both lists.

    Each side is reduced to its lists (:func:`value_lists`) and these are full-outer joined, so the
    join never sees raw rows. A key with more than ``most`` values on a side has several chunks.
    """
    lg = value_lists(left, [key], left_value, f"{left_value}_list", most)
    rg = value_lists(right, [key], right_value, f"{right_value}_list", most)
    j = lg.join(rg, on=[key, "chunk_no"], how="full_outer")
    empty = lambda df, c: F.coalesce(F.col(c), F.array().cast(df.schema[c].dataType)).alias(c)
    return j.select(key, "chunk_no", empty(lg, f"{left_value}_list"), empty(rg, f"{right_value}_list"))


# --- aggregates ---------------------------------------------------------------------------


def sum_by(df: DataFrame, keys: Sequence[str], value: str | Column, alias: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(c(value)).alias(alias))


def combine(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Combine per key (or globally with ``keys=[]``) with native aggregate expressions."""
    exprs = [e.alias(name) for name, e in aggs.items()]
    return df.groupBy(*keys).agg(*exprs) if keys else df.agg(*exprs)


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def customer_day(df: DataFrame, customer: str, ts: str, amount: str) -> DataFrame:
    """COUNT(*), SUM(amount), COUNTIF(amount > 0) per customer and calendar day."""
    return (df.groupBy(F.col(customer).alias("customer_id"), F.to_date(F.col(ts)).alias("event_date"))
              .agg(F.count(F.lit(1)).alias("total_events"),
                   F.sum(amount).alias("total_spent"),
                   F.count_if(F.col(amount) > 0).alias("total_purchases")))


def group_values(df: DataFrame, keys: Sequence[str], value: str, alias: str | None = None,
                 most: int = LIST_VALUES) -> DataFrame:
    """All values of a key together, sorted (GroupByKey): ``keys, chunk_no`` and a list of bounded size."""
    return value_lists(df, keys, value, alias or f"{value}_list", most)


def latest_agg(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Record with the greatest ``order`` tuple per key, as a two-stage aggregate.

    ``max_by(struct(all), struct(order))`` runs partially in every task (a hot key is
    reduced to one row per task before the shuffle) and merges after one Exchange.
    ``order`` must be a total order (add a unique tiebreak column).
    """
    payload = [x for x in df.columns if x not in keys]
    agg = df.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(x) for x in payload]), F.struct(*[F.col(o) for o in order])).alias("__rec"))
    return agg.select(*keys, *[F.col(f"__rec.{x}").alias(x) for x in payload])


def rfm(df: DataFrame, key: str, ts: str, amount: str, now: str) -> DataFrame:
    """Recency (days since last event), frequency (events), monetary (sum amount) per key."""
    return (df.groupBy(key)
              .agg(F.max(ts).alias("__last"), F.count(F.lit(1)).alias("frequency"), F.sum(amount).alias("monetary"))
              .select(key,
                      F.datediff(F.to_date(F.lit(now)), F.to_date("__last")).alias("recency_days"),
                      "frequency", "monetary"))


# --- windows ------------------------------------------------------------------------------


def top_k_per(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank_col: str | None = None) -> DataFrame:
    """Top ``k`` rows per group by ``order`` (which must be total: add a tiebreak)."""
    w = Window.partitionBy(*group).orderBy(*order)
    rn = "__rn" if rank_col is None else rank_col
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= k)
    return out.drop("__rn") if rank_col is None else out.withColumn(rn, F.col(rn).cast("bigint"))


def dedupe_by_order(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Window form of keep-one-per-key (``row_number() = 1``)."""
    return top_k_per(df, keys, order, 1)


#: Rows of a key that one task numbers; a key with more is cut into ranges.
RANK_ROWS = 1_000_000


def row_rank(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rn", most: int | None = RANK_ROWS) -> DataFrame:
    """ROW_NUMBER kept as a column (e.g. as a MERGE source).

    Rows of keys with more than ``most`` rows are dealt to ranges of (keys, order), about ``most`` rows each, and written; a row's
    number is its place in its range plus the counts of the ranges before. Equal rows are told apart by their place in the
    file, so a hot order value is cut too. ``None`` numbers every key in one task.
    """
    plain = lambda x: x.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint"))
    if most is None:
        return plain(df)
    large = stored(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > most), "large-keys")
    total = large.agg(F.sum("__n")).first()[0]
    if not total:
        return plain(df)
    some, rest = _of_keys(df, large, keys)
    # written before they are dealt: a file's row numbers hold when a task is run again
    placed = stored(some, "rank-rows").withColumn("__place", F.monotonically_increasing_id())
    ranged = placed.repartitionByRange(-(-total // most), *[F.col(k) for k in keys], *order, F.col("__place"))
    ranged = stored(ranged.withColumn("__range", F.spark_partition_id()), "rank-ranges")
    counts = ranged.groupBy(*keys, "__range").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"l.{k}")) for k in [*keys, "__range"]]
    inside = F.row_number().over(Window.partitionBy(*keys, "__range").orderBy(*order, "__place"))
    numbered = ranged.withColumn("__in", inside).alias("r").join(counts.alias("l"), same).select(
        *[F.col(f"r.{x}") for x in df.columns], (F.col("r.__in") + F.col("l.__before")).cast("bigint").alias(name))
    return numbered.unionByName(plain(rest))


def time_series_metrics(df: DataFrame, key: str, ts: str, value: str,
                        windows: Mapping[str, int] | None = None, exact_scale: int | None = None,
                        segment_rows: int | None = None) -> DataFrame:
    """LAG change, safe return and row-count moving averages over ONE shared window order.

    All expressions use the same ``partitionBy(key).orderBy(ts)`` spec so Spark sorts once.
    The first row has a NULL change; moving averages use a short frame at the start.
    With ``exact_scale`` the moving sums are exact decimals (``value`` has at most that many
    decimals), so the average does not depend on the summation order. ``segment_rows`` cuts each key's series into segments of so
    many rows, each with copies of the rows that its first frames reach back to, so a long series is done by many tasks.
    """
    windows = windows or {"moving_avg_7d": 7, "moving_avg_30d": 30}
    columns = df.columns
    if segment_rows:
        halo = max(1, *(rows - 1 for rows in windows.values()))
        if segment_rows < halo:
            raise ValueError(f"segments of {segment_rows} rows are shorter than the {halo} rows before a frame")
        df = row_rank(df, [key], [F.col(ts)], "__at")
        place, own = (F.col("__at") - 1) % segment_rows, F.floor((F.col("__at") - 1) / segment_rows)
        parts = F.when(place >= segment_rows - halo, F.array(own, own + 1)).otherwise(F.array(own))
        df = df.withColumn("__own", own).withColumn("__part", F.explode(parts))
        w = Window.partitionBy(key, "__part").orderBy("__at")
    else:
        w = Window.partitionBy(key).orderBy(ts)
    prev = F.lag(value).over(w)
    cols = {
        "daily_change": F.col(value) - prev,
        "daily_return_pct": safe_divide(F.col(value) - prev, prev),
    }
    for name, rows in windows.items():
        frame = w.rowsBetween(-(rows - 1), Window.currentRow)
        if exact_scale is None:
            cols[name] = F.avg(value).over(frame)
        else:
            exact = F.sum(F.col(value).cast(f"decimal(18,{exact_scale})")).over(frame).cast("double")
            cols[name] = exact / F.count(F.lit(1)).over(frame)
    out = df.withColumns(cols)
    if segment_rows:
        out = out.where("__own = __part")
    return out.select(*columns, *cols)


def lag_change(df: DataFrame, key: str, ts: str, value: str, name: str = "change") -> DataFrame:
    w = Window.partitionBy(key).orderBy(ts)
    return df.withColumn(name, F.col(value) - F.lag(value).over(w))


def lag_return(df: DataFrame, key: str, ts: str, value: str, name: str = "return_frac") -> DataFrame:
    w = Window.partitionBy(key).orderBy(ts)
    prev = F.lag(value).over(w)
    return df.withColumn(name, safe_divide(F.col(value) - prev, prev))


# --- sorts / limits -------------------------------------------------------------------------


def order(df: DataFrame, spec: Sequence[tuple[str, str]]) -> DataFrame:
    """``[(col, 'asc'|'desc')]`` → total sort (range-partitioned, no single-task sort)."""
    return df.orderBy(*[F.col(x).desc() if d.lower() == "desc" else F.col(x).asc() for x, d in spec])


def top_k(df: DataFrame, order_by: Sequence[Column], k: int) -> DataFrame:
    """Global top-k — ``TakeOrderedAndProject``: each task keeps k, the merge sees tasks×k rows."""
    return df.orderBy(*order_by).limit(k)


def sample_n(df: DataFrame, n: int, order_by: Sequence[Column] | None = None, seed: int = 42,
             key_cols: Sequence[str] | None = None) -> DataFrame:
    """A deterministic LIMIT-with-no-order replacement (the sampling operator).

    With ``order_by`` it is a top-n; otherwise rows are ranked by the md5 of the seed and
    ``key_cols`` (joined by ``|``) so repeated runs, and other engines, pick the same rows.
    """
    if order_by is not None:
        return df.orderBy(*order_by).limit(n)
    cols = [F.col(x) for x in (key_cols or df.columns)]
    mark = F.md5(F.concat_ws("|", F.lit(str(seed)), *[x.cast("string") for x in cols]).cast("binary"))
    return df.orderBy(mark, *cols).limit(n)


def preview(df: DataFrame, n: int, order_by: Sequence[Column]) -> DataFrame:
    """First ``n`` rows in a stated order (what ``show()`` would print, as a DataFrame)."""
    return df.orderBy(*order_by).limit(n)

"""Declarative row validation with dead-letter routing, cleansing and DQ measures.

A :class:`Rule` is an error code plus a *failure* predicate. :func:`validate` turns an
ordered rule list into ONE projection — ``concat(when(p1,'C1;').otherwise(''), ...)`` —
so the whole rule set runs inside whole-stage codegen with no Python in the hot path and
no extra pass over the data. Rules run on the raw values; cleansing runs after them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


ERRORS = "validation_errors"
VALID = "is_valid"


@dataclass(frozen=True)
class Rule:
    """``fails`` is a Column (or a DataFrame → Column callable) that is TRUE on failure.

    A NULL failure predicate does not fail the row; rules state NULL handling explicitly
    (``isNull() | (x <= 0)``).
    """

    code: str
    fails: Column | Callable[[DataFrame], Column]

    def predicate(self, df: DataFrame) -> Column:
        return self.fails if isinstance(self.fails, Column) else self.fails(df)


def error_codes(df: DataFrame, rules: Sequence[Rule]) -> Column:
    parts = [F.when(r.predicate(df), F.lit(f"{r.code};")).otherwise(F.lit("")) for r in rules]
    return F.concat(*parts) if parts else F.lit("")


def validate(df: DataFrame, rules: Sequence[Rule], errors: str = ERRORS, valid: str = VALID) -> DataFrame:
    """Append ``errors`` (``CODE;`` per failed rule, in rule order) and ``valid`` flag."""
    out = df.withColumn(errors, error_codes(df, rules))
    return out.withColumn(valid, F.col(errors) == F.lit(""))


def split(df: DataFrame, errors: str = ERRORS, valid: str = VALID) -> tuple[DataFrame, DataFrame]:
    """(clean, dlq): clean drops both helper columns, the DLQ keeps the reasons."""
    clean = df.filter(F.col(valid)).drop(valid, errors)
    dlq = df.filter(~F.col(valid)).drop(valid)
    return clean, dlq


# --- rule sets -------------------------------------------------------------------------


# fixed values: the web-event error codes, in rule order — ID_NULL, USER_ID_INVALID,
# CREATED_AT_NULL, SESSION_ID_EMPTY, CITY_EMPTY — each appended as "CODE;"
def event_rules(
    id_col: str = "id",
    user_col: str = "user_id",
    created_col: str = "created_at",
    session_col: str = "session_id",
    city_col: str = "city",
) -> list[Rule]:
    """Web-event rules; column names are parameters so other schemas can reuse them."""
    return [
        Rule("ID_NULL", F.col(id_col).isNull()),
        Rule("USER_ID_INVALID", F.col(user_col).isNotNull() & (F.col(user_col) <= 0)),
        Rule("CREATED_AT_NULL", F.col(created_col).isNull()),
        Rule("SESSION_ID_EMPTY", F.col(session_col).isNotNull() & (F.trim(F.col(session_col)) == "")),
        Rule("CITY_EMPTY", F.col(city_col).isNotNull() & (F.trim(F.col(city_col)) == "")),
    ]


# fixed values: the string columns the event cleansing trims
EVENT_STRING_COLUMNS = [
    "session_id", "ip_address", "city", "state", "postal_code",
    "browser", "traffic_source", "uri", "event_type",
]


# fixed values: the price-bar error codes, in rule order — INVALID_CLOSE, INVALID_VOLUME, MISSING_KEY
def price_rules(close: str = "close", volume: str = "volume", date: str = "date", ticker: str = "ticker") -> list[Rule]:
    """Daily price bar rules."""
    return [
        Rule("INVALID_CLOSE", F.col(close).isNull() | (F.col(close) <= 0)),
        Rule("INVALID_VOLUME", F.col(volume).isNull() | (F.col(volume) < 0)),
        Rule("MISSING_KEY", F.col(date).isNull() | F.col(ticker).isNull()),
    ]


# fixed value: the e-mail pattern of the contact-quality check
EMAIL_REGEX = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def email_rules(id_col: str = "id", email_col: str = "email", regex: str = EMAIL_REGEX) -> list[Rule]:
    """Contact rules: id present, email present, email well formed."""
    return [
        Rule("ID_NULL", F.col(id_col).isNull()),
        Rule("EMAIL_NULL", F.col(email_col).isNull()),
        Rule("EMAIL_INVALID", F.col(email_col).isNotNull() & ~F.col(email_col).rlike(regex)),
    ]


def standard_rules(not_null_cols: Sequence[str], country_col: str | None = None,
                   valid_country_codes: Sequence[str] = ()) -> list[Rule]:
    """Generic builder: required columns and an allowed-value list."""
    rules = [Rule(f"{x.upper()}_NULL", F.col(x).isNull()) for x in not_null_cols]
    if country_col is not None:
        rules.append(Rule(f"{country_col.upper()}_NOT_ALLOWED",
                          F.col(country_col).isNotNull() & ~F.col(country_col).isin(list(valid_country_codes))))
    return rules


def apply_standard_validations(df: DataFrame, not_null_cols: Sequence[str], country_col: str | None = None,
                               valid_country_codes: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(clean, dlq) for the standard rule set."""
    return split(validate(df, standard_rules(not_null_cols, country_col, valid_country_codes)))


def amount_rules(amount: str = "amount") -> list[Rule]:
    """Amount missing / non-numeric / negative (``try_cast`` so ANSI mode does not throw)."""
    num = F.col(amount).cast("string").try_cast("decimal(38,9)")
    return [
        Rule("AMOUNT_MISSING", F.col(amount).isNull() | (F.trim(F.col(amount).cast("string")) == "")),
        Rule("AMOUNT_NOT_NUMERIC", F.col(amount).isNotNull() & (F.trim(F.col(amount).cast("string")) != "") & num.isNull()),
        Rule("AMOUNT_NEGATIVE", num < 0),
    ]


def error_record(df: DataFrame, id_col: str, stage: str, run_id: str, errors: str = ERRORS,
                 severity: str = "ERROR") -> DataFrame:
    """Attach a structured error record (message, severity, record id, stage, correlation id)."""
    return df.withColumn(
        "error",
        F.struct(
            F.col(errors).alias("message"),
            F.lit(severity).alias("severity"),
            F.col(id_col).cast("string").alias("record_id"),
            F.lit(stage).alias("stage"),
            F.lit(run_id).alias("correlation_id"),
        ),
    )


# --- cleansing -------------------------------------------------------------------------


def fill_null(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """``coalesce(col, value)`` for each column — run after the rules that read the raw value."""
    return df.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in values.items()})


def trim_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Trim several string columns in one projection (only those present)."""
    present = [x for x in cols if x in df.columns]
    return df.withColumns({x: F.trim(F.col(x)) for x in present})


def clean_events(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Event DQ flow: rules on raw values → fill user_id → trim → split."""
    checked = validate(df, event_rules())
    checked = fill_null(checked, {"user_id": -1})
    checked = trim_columns(checked, EVENT_STRING_COLUMNS)
    return split(checked)


# --- measures --------------------------------------------------------------------------


def profile(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Single-pass DQ scores: share of rows where each check holds (NULL = fails), plus rows."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.avg(F.coalesce(pred, F.lit(False)).cast("double")).alias(name) for name, pred in checks.items()]
    return df.agg(*aggs)


def completeness_checks(cols: Sequence[str]) -> dict[str, Column]:
    return {f"complete_{x}": F.col(x).isNotNull() for x in cols}


def error_counts(dlq: DataFrame, errors: str = ERRORS, period_col: str | None = None) -> DataFrame:
    """Counts per error code (and period): ``explode(split(errors, ';'))`` → group count."""
    codes = dlq.select(*([period_col] if period_col else []),
                       F.explode(F.split(F.col(errors), ";")).alias("error_code"))
    codes = codes.filter(F.col("error_code") != "")
    keys = ([period_col] if period_col else []) + ["error_code"]
    return codes.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_errors"))


def _run_measures(ok: Column, ts: Column) -> list[Column]:
    return [F.count_if(ok).alias("processed"), F.count_if(~ok).alias("dead_lettered"), F.max(F.when(ok, ts)).alias("latest_ts")]


def _run_health(measures: DataFrame, now: str, max_dlq_share: float, max_lag_hours: float) -> DataFrame:
    lag_h = (F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.col("latest_ts").cast("timestamp"))) / 3600.0
    share = F.when(F.col("processed") + F.col("dead_lettered") > 0,
                   F.col("dead_lettered") / (F.col("processed") + F.col("dead_lettered"))).otherwise(F.lit(0.0))
    return measures.select(
        "processed", "dead_lettered",
        F.round(share, 6).alias("dlq_share"),
        F.round(lag_h, 3).alias("lag_hours"),
        (share > max_dlq_share).alias("alert_dlq"),
        (lag_h > max_lag_hours).alias("alert_stale"),
    )


def health(df: DataFrame, dlq: DataFrame, ts_col: str, now: str, max_dlq_share: float = 0.05,
           max_lag_hours: float = 24.0) -> DataFrame:
    """One-row run health: processed rows, DLQ rows, freshness lag, and threshold alerts.

    Both inputs are tagged, unioned and reduced by ONE global aggregate (partial per task,
    one final row) — nothing is joined or collected. A run that writes its rows anyway measures them
    on the way, without reading them again: :func:`write_checked`.
    """
    tagged = (df.select(F.col(ts_col).alias("__ts"), F.lit(True).alias("__ok"))
              .unionByName(dlq.select(F.col(ts_col).alias("__ts"), F.lit(False).alias("__ok"))))
    return _run_health(tagged.agg(*_run_measures(F.col("__ok"), F.col("__ts"))), now, max_dlq_share, max_lag_hours)


def write_checked(checked: DataFrame, path: str, ts_col: str, valid: str = VALID) -> dict:
    """Writes validated rows once, valid and dead-lettered ones in a folder each (``valid=true``, ``valid=false``), and returns
    the run's measures, observed by the tasks that write: processed, dead_lettered, latest_ts."""
    seen = Observation("checked")
    ok = F.coalesce(F.col(valid), F.lit(False))
    rows = checked.withColumn(valid, ok).observe(seen, *_run_measures(F.col(valid), F.col(ts_col)))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(valid).parquet(path)
    return seen.get


def health_of(spark: SparkSession, measures: dict, now: str, max_dlq_share: float = 0.05, max_lag_hours: float = 24.0) -> DataFrame:
    """The :func:`health` row of measures that a write has taken (a few numbers)."""
    row = spark.createDataFrame([(measures["processed"], measures["dead_lettered"], measures["latest_ts"])],
                                "processed bigint, dead_lettered bigint, latest_ts timestamp_ntz")
    return _run_health(row, now, max_dlq_share, max_lag_hours)


def orphans(child: DataFrame, keys: Sequence[str], parent: DataFrame, parent_keys: Sequence[str], name: str) -> DataFrame:
    """``check, rows, bad_rows``: rows of ``child`` whose key ``parent`` doesn't have (a null key has no parent).

    The child is counted per key before the join, so a hot key crosses the shuffle as one row a task; Spark may put
    a runtime Bloom filter of the parent's keys before it.
    """
    counts = child.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("__n"))
    known = parent.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(parent_keys)]).distinct()
    on = [f"__k{i}" for i in range(len(keys))]
    both = counts.join(known.withColumn("__there", F.lit(True)), on, "left")
    return both.agg(F.lit(name).alias("check"), F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"),
                    F.coalesce(F.sum(F.when(F.col("__there").isNull(), F.col("__n"))), F.lit(0)).alias("bad_rows")).select("check", "rows", "bad_rows")


def mismatches(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str, other: str, name: str) -> DataFrame:
    """``check, rows, bad_rows``: matching rows whose ``value`` and ``other`` (of the right side) differ; nulls are equal to each other."""
    both = left.select(*keys, F.col(value).alias("__l")).join(right.select(*keys, F.col(other).alias("__r")), list(keys))
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("__l").eqNullSafe(F.col("__r"))).alias("bad_rows")).select(
        F.lit(name).alias("check"), "rows", "bad_rows")


def error_delta(dlq: DataFrame, ts_col: str, period: str = "day", errors: str = ERRORS) -> DataFrame:
    """Error counter per period (``day``/``week``/``month``/``year``) and its change vs the
    previous period of the same code.

    The window runs over the per-(period, code) aggregate — a few rows per code — never
    over raw rows.
    """
    per = (dlq.select(F.to_date(F.date_trunc(period, F.col(ts_col))).alias("period_start"),
                      F.explode(F.split(F.col(errors), ";")).alias("error_code"))
              .filter(F.col("error_code") != "")
              .groupBy("period_start", "error_code").agg(F.count(F.lit(1)).alias("n_errors")))
    w = Window.partitionBy("error_code").orderBy("period_start")
    return per.withColumn("delta", F.col("n_errors") - F.lag("n_errors").over(w))


__all__ = [
    "Rule", "validate", "split", "event_rules", "price_rules", "email_rules", "standard_rules",
    "apply_standard_validations", "amount_rules", "error_record", "fill_null", "trim_columns",
    "clean_events", "profile", "completeness_checks", "error_counts", "health", "write_checked", "health_of",
    "orphans", "mismatches", "error_delta",
]

"""Cross-site boilerplate removal by the number of distinct sites a line is on.

Every line with a word gets a key: two 64-bit hashes of its words (white space collapsed, case kept).
``spread`` builds one HyperLogLog sketch of sites a key; partial sketches merge in the
aggregation, so a line on a third of all rows leaves each task as one small sketch.
Lines whose estimate lies near the threshold get their sites counted exactly; the others are
far enough from it for the sketch's error. ``dedup`` then drops the lines on ``min_sites``
sites or more from all documents.

A document all of whose words are in such lines has no text of its own to keep: it is a copy of one that is on
many sites (or a notice alone). It stays whole, for the near-duplicate join to keep one of the copies; every
other document loses its boilerplate lines, whatever their share.

Defined results: a null site counts as one site of its own; a null text stays null, an empty
one empty; lines without a word are never counted nor dropped; a line repeated in a document counts its
site once. Repeated rows and ids each keep their row. Rows are matched by hashes of id and
text, so equal rows are treated alike. Extra columns are kept. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import SPACES, stored, temp_names
from lakeloom.llm.common import words as common_words

#: Rows of a small side that may be broadcast (keys: 16 bytes each); more go by a shuffle join.
BROADCAST_ROWS = 500_000
#: Bytes of lines' numbers and words that may be broadcast.
BROADCAST_BYTES = 32 << 20


def _row_keys(df: DataFrame, key: str, text: str) -> list:
    return [F.xxhash64(F.col(key), F.col(text)).alias("r1"), F.xxhash64(F.lit(1), F.col(text), F.col(key)).alias("r2")]


def lines(df: DataFrame, *more, text: str = "text") -> DataFrame:
    """One row per line with a word: its number, its key (h1, h2), its words, and the columns ``more``."""
    x = df.select(*more, F.posexplode(F.split(F.col(text), "\n")).alias("at", "line"))
    x = x.withColumn("line", F.trim(F.regexp_replace("line", SPACES, " "))).where("line <> ''")
    return x.select(*[c for c in x.columns if c != "line"], F.xxhash64("line").alias("h1"),
                    F.xxhash64(F.lit(1), F.col("line")).alias("h2"),
                    (F.length("line") - F.length(F.translate("line", " ", "")) + 1).alias("words"))


def spread(df: DataFrame, min_sites: int, site: str = "source", text: str = "text", lg_k: int = 11) -> DataFrame:
    """``(h1, h2)`` of the lines on ``min_sites`` distinct sites or more.

    The sketch's relative error is about 1.04 / sqrt(2^lg_k); estimates within five errors of
    the threshold (and one site) are settled by an exact count of distinct sites.
    """
    named = F.coalesce(F.concat(F.lit("s"), F.col(site).cast("string")), F.lit("n")).alias("site")
    rows = lines(df, named, text=text)
    sketches = rows.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("s"))
    near = 1 + 5 * 1.04 / (1 << lg_k) ** 0.5 * min_sites
    sites = sketches.select("h1", "h2", F.hll_sketch_estimate("s").alias("sites")).where(F.col("sites") >= min_sites - near)
    sites = stored(sites, "spread")
    sure = sites.where(F.col("sites") > min_sites + near).select("h1", "h2")
    unsure = _small(sites.where(F.col("sites") <= min_sites + near).select("h1", "h2"))
    exact = rows.join(unsure, ["h1", "h2"], "left_semi").select("h1", "h2", "site").distinct()
    exact = exact.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_sites).select("h1", "h2")
    return sure.unionByName(exact)


def _small(df: DataFrame, bytes_each: Column | None = None) -> DataFrame:
    """``df`` marked for broadcast if it has few rows (and bytes); else left to a shuffle join."""
    size = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.lit(0) if bytes_each is None else bytes_each).alias("b")).first()
    return F.broadcast(df) if size["n"] <= BROADCAST_ROWS and (size["b"] or 0) <= BROADCAST_BYTES else df


def boilerplate(df: DataFrame, min_sites: int, key: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """Per distinct row (r1, r2) that holds boilerplate: ``hits``, the lines' numbers and words."""
    keys = _small(stored(spread(df, min_sites, site, text), "boilerplate"))
    rows = lines(df, *_row_keys(df, key, text), text=text).join(keys, ["h1", "h2"])
    return rows.groupBy("r1", "r2").agg(F.collect_set(F.struct("at", "words")).alias("hits"))


def dedup(df: DataFrame, min_sites: int = 8, key: str = "doc_id", text: str = "text", site: str = "source",
          names: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """``df`` with boilerplate lines cut out of ``text``, and two ints that replace columns of their ``names``."""
    r1, r2, hits, every, cuts = temp_names(df, "_r1", "_r2", "_hits", "_every", "_cuts")
    found = stored(boilerplate(df, min_sites, key, text, site), "drops")
    found = _small(found.select(F.col("r1").alias(r1), F.col("r2").alias(r2), F.col("hits").alias(hits)),
                   40 + 16 * F.size(hits))
    keys = [k.alias(n) for k, n in zip(_row_keys(df, key, text), (r1, r2), strict=True)]
    x = df.select("*", *keys).join(found, [r1, r2], "left")
    dropped = F.aggregate(hits, F.lit(0).cast("bigint"), lambda a, h: a + h["words"])
    whole = F.col(hits).isNull() | (dropped >= F.size(common_words(F.col(text))))
    x = x.withColumn(hits, F.when(~whole, F.sort_array(F.transform(hits, lambda h: h["at"]))))
    x = x.withColumn(every, F.split(F.col(text), "\n"))
    # the kept lines are the slices between neighbouring dropped ones
    x = x.withColumn(cuts, F.concat(F.array(F.lit(-1)), hits, F.array(F.size(every))))
    slices = F.transform(F.sequence(F.lit(0), F.size(cuts) - 2), lambda k: F.slice(
        F.col(every), F.get(F.col(cuts), k) + 2, F.get(F.col(cuts), k + 1) - F.get(F.col(cuts), k) - 1))
    return x.select(*[F.when(F.col(hits).isNull(), F.col(text)).otherwise(F.array_join(F.flatten(slices), "\n")).alias(text)
                      if c == text else F.col(f"`{c}`") for c in df.columns if c.lower() not in names],
                    F.coalesce(F.size(every), F.lit(0)).alias(names[0]), F.coalesce(F.size(hits), F.lit(0)).alias(names[1]))


def clean(docs: DataFrame, min_sites: int = 8) -> DataFrame:
    """Pipeline stage: the documents without boilerplate lines; n_chars follows the text if it is there."""
    names = temp_names(docs, "_n_lines", "_n_dropped")
    x = dedup(docs, min_sites, names=tuple(names))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        x = x.withColumn("n_chars", F.when(F.col(names[1]) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    return x.select(*[F.col(f"`{c}`") for c in docs.columns])

"""License scans by diagonal voting (native: DataFrame functions only).

Templates are license notices and short phrases that name a license. A word is a run of letters, digits
and non-ASCII characters, with A-Z in lower case.

1. *Join.* The hashes of all rolling word k-grams of each document are joined with the grams' positions in
   the templates (k is 4, or 2 for templates under four words). One more gram a document, which meets a
   template of no words, carries its word count along, so that no document is lost.
2. *Diagonals.* Hits are counted by (document, template, offset): grams of one place lie on one diagonal.
3. *Neighbours.* A word put in or left out moves the rest of a place by one diagonal. Diagonals no further
   apart than ``slack`` (none for phrases, up to three words for notices) are merged; places with enough
   votes are candidates.
4. *Spans.* Documents with candidates are read again and their words compared with the template's along the
   merged diagonals. A phrase must match whole. A notice counts if at least ``share`` percent of its
   words match. Notices whose spans overlap form a cluster, in which the best cover stays (all of
   them on a tie), so a notice isn't also taken for its look-alikes.

Defined results: a null or empty text has no words, no places and the score 0. Repeated rows each get a row;
rows of one id with different texts are scanned apart. A null id is carried. Extra columns aren't read. An
empty table gives an empty result. ``score`` is the best share of a template's words found in one place (1 for a phrase).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.llm.common import stored

# The phrases and labels of the base scan.
PHRASES = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]
# Opening sentences of public license notices.
NOTICES = [
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
             "Public License as published by the Free Software Foundation"),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
             "Public License as published by the Free Software Foundation"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "All rights reserved"),
]
TEMPLATES = [(label, text, True) for label, text in PHRASES] + [(label, text, False) for label, text in NOTICES]

#: Words of a gram: long templates, and those under four words.
LONG, SHORT = 4, 2
#: The gram that every document has once; it meets the template of no words (number -1).
MARK = 0
#: Rows of a small side that may be broadcast (at most 64 bytes each); more go by a shuffle join.
BROADCAST_ROWS = 200_000
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text, A-Z lower-cased."""
    low = F.translate(F.coalesce(text, F.lit("")), ASCII_UPPER, ASCII_UPPER.lower())
    return F.array_remove(F.split(low, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), "")


def templates(spark: SparkSession, rows: list[tuple[str, str, bool]] = TEMPLATES) -> DataFrame:
    """``template, label, exact, tw, n, k, slack`` of each (label, text, whole match wanted)."""
    if any(not text for _, text, _ in rows):
        raise ValueError("a template needs words")
    each = [F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(exact).alias("exact"), words(F.lit(text)).alias("tw"))
            for i, (label, text, exact) in enumerate(rows)]
    x = spark.range(1).select(F.inline(F.array(*each))).withColumn("n", F.size("tw"))
    x = x.withColumn("k", F.when(F.col("n") < LONG, F.least(F.col("n"), F.lit(SHORT))).otherwise(LONG))
    return x.withColumn("slack", F.when(F.col("exact"), 0).otherwise(F.least(F.lit(3), F.floor(F.col("n") / 4).cast("int"))))


def _grams(hashes: Column, k: int) -> Column:
    """Hashes of all rolling ``k``-grams, from the words' hashes."""
    starts = F.when(F.size(hashes) >= k, F.sequence(F.lit(0), F.size(hashes) - k))
    grams = F.transform(starts, lambda at: F.xxhash64(F.lit(k), *[F.get(hashes, at + i) for i in range(k)]))
    return F.coalesce(grams, F.array().cast("array<bigint>"))


def _hashes(tokens: Column) -> Column:
    return F.transform(tokens, lambda w: F.xxhash64(w))


def _small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it has few rows; else left to a shuffle join."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _row(key: str, text: str) -> list[Column]:
    return [F.xxhash64(F.col(key), F.col(text)).alias("r1"), F.xxhash64(F.lit(1), F.col(text), F.col(key)).alias("r2")]


def votes(docs: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All gram hits: ``doc_id, r1, r2, n_words, template, t_at, at``; and one row a document with template -1."""
    sizes = sorted(r["k"] for r in known.select("k").distinct().collect())  # three sizes at most
    own = known.select("template", "k", _hashes(F.col("tw")).alias("h")).select(
        "template", "k", F.posexplode(F.coalesce(*[F.when(F.col("k") == k, _grams(F.col("h"), k)) for k in sizes])).alias("t_at", "h"))
    mark = own.sparkSession.range(1).select(F.lit(-1).alias("template"), F.lit(0).alias("k"), F.lit(0).alias("t_at"),
                                            F.lit(MARK).cast("bigint").alias("h"))
    own = _small(stored(own.unionByName(mark), "license-grams"))
    x = docs.select(F.col(key).alias("doc_id"), *_row(key, text), words(F.col(text)).alias("w"))
    x = x.select("doc_id", "r1", "r2", F.size("w").alias("n_words"), _hashes(F.col("w")).alias("hs"))
    grams = F.concat(F.array(F.lit(MARK).cast("bigint")), *[_grams(F.col("hs"), k) for k in sizes])
    x = x.select("doc_id", "r1", "r2", "n_words", F.posexplode(grams).alias("pos", "h")).join(own, "h")
    before, at = F.lit(1), F.lit(0)
    for k in sizes:
        at = F.when(F.col("k") == k, F.col("pos") - before).otherwise(at)
        before = before + F.greatest(F.col("n_words") - (k - 1), F.lit(0))
    # the mark is the first gram; no other may pass for it
    x = x.where((F.col("template") >= 0) == (F.col("pos") > 0))
    return x.select("doc_id", "r1", "r2", "n_words", "template", "t_at", at.alias("at"))


def candidates(hits: DataFrame, known: DataFrame, least_votes: int = 10) -> DataFrame:
    """Merged neighbouring diagonals with at least ``least_votes`` percent of the template's grams, per row."""
    x = hits.where("template >= 0").groupBy("r1", "r2", "template", (F.col("at") - F.col("t_at")).alias("diagonal")).agg(
        F.size(F.collect_set("t_at")).alias("votes"))  # a template's length bounds the set
    x = x.join(_small(known), "template")
    order = Window.partitionBy("r1", "r2", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > F.col("slack"), F.lit(True))
    x = x.withColumn("place", F.sum(apart.cast("int")).over(order))
    x = x.groupBy("r1", "r2", "template", "place").agg(
        F.collect_list("diagonal").alias("diagonals"), F.sum("votes").alias("votes"),
        *[F.first(c).alias(c) for c in ("label", "exact", "tw", "n", "k")])
    return x.where(F.col("votes") * 100 >= (F.col("n") - F.col("k") + 1) * least_votes)


def spans(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Candidates held against the documents' words: ``r1, r2, template, label, exact, n, start, end, n_match``."""
    # one document's places are gathered beside its words, so the words aren't copied for each
    found = stored(found.groupBy("r1", "r2").agg(F.collect_list(F.struct(
        "template", "label", "exact", "n", "tw", "diagonals")).alias("places")), "license-places")
    x = docs.select(*_row(key, text), F.col(text).alias("text")).join(_small(found.select("r1", "r2")), ["r1", "r2"], "left_semi")
    x = x.dropDuplicates(["r1", "r2"]).join(found, ["r1", "r2"]).select("r1", "r2", words(F.col("text")).alias("w"), "places")

    def matches(p: Column) -> Column:
        along = lambda d: F.transform(
            F.filter(F.sequence(F.lit(0), p["n"] - 1), lambda t: F.get("w", t + d) == F.get(p["tw"], t)),
            lambda t: F.struct(t.alias("t"), (t + d).alias("at")))
        return F.flatten(F.transform(p["diagonals"], along))

    x = x.select("r1", "r2", F.inline(F.transform("places", lambda p: F.struct(
        p["template"].alias("template"), p["label"].alias("label"), p["exact"].alias("exact"), p["n"].alias("n"), matches(p).alias("m")))))
    x = x.select("r1", "r2", "template", "label", "exact", "n", F.array_min(F.transform("m", lambda y: y["at"])).alias("start"),
                 F.array_max(F.transform("m", lambda y: y["at"])).alias("end"),
                 F.size(F.array_distinct(F.transform("m", lambda y: y["t"]))).alias("n_match"))
    return x.where((F.col("n_match") > 0) & (~F.col("exact") | (F.col("n_match") == F.col("n"))))


def settled(found: DataFrame, share: int = 75) -> DataFrame:
    """``found`` with ``cover`` (share of the template's words) and ``kept``: phrases, and the best notices of each cluster."""
    x = found.withColumn("cover", F.col("n_match") / F.col("n"))
    notice = ~F.col("exact") & (F.col("n_match") * 100 >= F.col("n") * share)
    start, end = (F.when(notice, F.col(c)) for c in ("start", "end"))
    order = Window.partitionBy("r1", "r2").orderBy("start", "end", "template")
    before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    first = F.coalesce(start > before, before.isNull()) & notice
    x = x.withColumn("cluster", F.sum(first.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    best = F.max(F.when(notice, F.col("cover"))).over(Window.partitionBy("r1", "r2", "cluster"))
    return x.withColumn("kept", F.col("exact") | (notice & (F.col("cover") == best))).drop("cluster")


def scan(docs: DataFrame, rows: list[tuple[str, str, bool]] = TEMPLATES, least_votes: int = 10, share: int = 75,
         key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    known = templates(docs.sparkSession, rows)
    hits = stored(votes(docs, known, key, text), "license-hits")
    places = settled(spans(docs, candidates(hits, known, least_votes), key, text), share)
    base, names = F.col("exact"), lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    found = places.groupBy("r1", "r2").agg(
        F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("start"))).cast("bigint").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("bigint").alias("last_word"),
        names(F.when(base, F.col("label"))).alias("base_labels"), names(F.when(F.col("kept"), F.col("label"))).alias("labels"),
        F.max("cover").alias("score"))
    x = hits.where("template < 0").select("doc_id", "r1", "r2", F.col("n_words").cast("bigint").alias("n_words")).join(
        found, ["r1", "r2"], "left")
    return x.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"), "first_word", "last_word",
                    F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
                    F.coalesce("score", F.lit(0.0)).alias("score"))


def oracle(rows: list[tuple[str, str, bool]] = TEMPLATES, least_votes: int = 10, share: int = 75) -> str:
    """DuckDB SQL for :func:`scan`: the same places from grams compared as text."""
    tokens = lambda c: (f"list_filter(string_split_regex(translate(coalesce({c}, ''), '{ASCII_UPPER}', '{ASCII_UPPER.lower()}'), "  # noqa: E731
                        r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")
    values = ", ".join(f"({i}, '{label}', {exact}, '{text}')" for i, (label, text, exact) in enumerate(rows))
    return rf"""
WITH named(template, label, exact, text) AS (VALUES {values}),
sized AS (SELECT *, {tokens("text")} AS tw, len({tokens("text")}) AS n FROM named),
t AS (SELECT *, CASE WHEN n < {LONG} THEN least(n, {SHORT}) ELSE {LONG} END AS k, CASE WHEN exact THEN 0 ELSE least(3, n // 4) END AS slack FROM sized),
d AS (SELECT doc_id, {tokens("text")} AS w, len({tokens("text")}) AS n_words FROM documents),
tg AS (SELECT template, k, t_at, array_to_string(tw[t_at + 1:t_at + k], ' ') AS g FROM (SELECT *, unnest(range(n - k + 1)) AS t_at FROM t)),
ks AS (SELECT DISTINCT k FROM t),
dg AS (SELECT doc_id, k, d_at, array_to_string(w[d_at + 1:d_at + k], ' ') AS g
       FROM (SELECT d.*, k, unnest(range(greatest(n_words - k + 1, 0))) AS d_at FROM d, ks)),
v AS (SELECT doc_id, template, d_at - t_at AS diagonal, count(DISTINCT t_at) AS votes
      FROM dg JOIN tg USING (k, g) GROUP BY ALL),
a AS (SELECT v.*, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) <= slack THEN 0 ELSE 1 END AS apart
      FROM v JOIN t USING (template)),
p AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS place FROM a),
c AS (SELECT doc_id, template, place, sum(votes) AS votes, list(diagonal) AS diagonals FROM p GROUP BY ALL),
e AS (SELECT c.*, unnest(diagonals) AS dg FROM c JOIN t USING (template) WHERE votes * 100 >= (n - k + 1) * {least_votes}),
f AS (SELECT e.doc_id, e.template, e.place, e.dg, t.n, t.label, t.exact, t.tw, d.w, unnest(range(t.n)) AS pos
      FROM e JOIN t USING (template) JOIN d USING (doc_id)),
m AS (SELECT doc_id, template, place, label, exact, n, count(DISTINCT pos) AS n_match, min(pos + dg) AS first_at, max(pos + dg) AS last_at
      FROM f WHERE pos + dg >= 0 AND w[pos + dg + 1] = tw[pos + 1] GROUP BY ALL),
s AS (SELECT *, n_match / n AS cover, NOT exact AND n_match * 100 >= n * {share} AS notice FROM m WHERE NOT exact OR n_match = n),
o AS (SELECT *, max(CASE WHEN notice THEN last_at END) OVER (PARTITION BY doc_id ORDER BY first_at, last_at, template
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s),
u AS (SELECT *, sum(CASE WHEN notice AND (before IS NULL OR first_at > before) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id
              ORDER BY first_at, last_at, template ROWS UNBOUNDED PRECEDING) AS cluster FROM o),
b AS (SELECT *, exact OR (notice AND cover = max(CASE WHEN notice THEN cover END) OVER (PARTITION BY doc_id, cluster)) AS kept FROM u),
r AS (SELECT doc_id, count(*) FILTER (exact) AS n_base, min(first_at) FILTER (exact) AS first_word, max(first_at) FILTER (exact) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact) AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (kept) AS labels, max(cover) AS score FROM b GROUP BY doc_id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN r USING (doc_id)"""

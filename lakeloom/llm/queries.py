"""Registered queries of the training-data operators: ``opN_<name>`` over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import (common, conversation_repair, decontaminate, hard_negatives, html_extract, license_scan, line_dedup, ngram_join,
                          quality, sentencepieces, sharding, token_counts, token_output, toxicity)

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return deco


WORDS_SQL = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


@query("op10_quality_rules", rf"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, {WORDS_SQL} AS ws,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
    FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM d),
g AS (SELECT doc_id, pos, w AS a, lead(w, 1) OVER o AS b, lead(w, 2) OVER o AS c
      FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
r AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g WHERE c IS NOT NULL),
p AS (SELECT DISTINCT doc_id, pos + k AS pos FROM r, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1),
rep AS (SELECT doc_id, count(*) AS n FROM p GROUP BY doc_id),
m AS (
    SELECT d.doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, len(ls) AS n_lines
    FROM d LEFT JOIN rep ON d.doc_id = rep.doc_id),
f AS (
    SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN n_repeat_words * 100 > n_words * 50 THEN 2 ELSE 0 END)
         + (CASE WHEN n_symbols * 10 > n_words THEN 4 ELSE 0 END) + (CASE WHEN n_dup_lines * 2 > n_lines THEN 8 ELSE 0 END)
         + (CASE WHEN word_chars < n_words * 2 THEN 16 ELSE 0 END) + (CASE WHEN word_chars > n_words * 30 THEN 32 ELSE 0 END)
         + (CASE WHEN n_lines * 2 > n_words THEN 64 ELSE 0 END) AS failed
    FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, (failed & 3) <> 0 AS base_failed,
       (failed & 63) = 0 AS kept, CAST(failed AS BIGINT) AS failed
FROM f
""")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = quality.verdicts(common.documents(spark, sf_dir, "doc_id", "text"))
    counts = [F.col("measures")[k].alias(k) for k in quality.MEASURES if k != "n_lines"]
    return x.select("doc_id", *counts, "base_failed", "kept", "failed")


@query("op9_sharding")
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(common.documents(spark, sf_dir, "doc_id", "text"), shards=40)


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op3_token_output")
def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir, "doc_id", "text")
    return token_output.token_table(docs, vocabulary("word_bpe_49k.json"))


@query("op2_sentencepiece")
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: token count, checksum of the ids, and whether decoding gave the text back."""
    docs = common.documents(spark, sf_dir, "doc_id", "text")
    return sentencepieces.round_trip(docs, vocabulary("piece_bpe_32k.model"))


@query("op1_ngram_join")
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(common.documents(spark, sf_dir, "doc_id", "text"))


@query("op6_line_dedup", r"""
WITH l AS (
    SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM documents),
k AS (SELECT *, trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS key FROM l),
n AS (SELECT *, len(string_split(key, ' ')) AS words FROM k WHERE key <> ''),
b AS (SELECT key FROM n GROUP BY key HAVING count(DISTINCT coalesce('s' || source, 'n')) >= 8),
h AS (SELECT doc_id, pos, words FROM n WHERE key IN (SELECT key FROM b)),
t AS (SELECT doc_id, sum(words) AS words FROM n GROUP BY doc_id),
cut AS (SELECT h.doc_id FROM h JOIN t ON h.doc_id = t.doc_id GROUP BY h.doc_id, t.words HAVING sum(h.words) < t.words),
kept AS (
    SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.pos) AS text
    FROM l LEFT JOIN h ON l.doc_id = h.doc_id AND l.pos = h.pos WHERE h.pos IS NULL GROUP BY l.doc_id),
dropped AS (SELECT doc_id, count(*) AS n FROM h WHERE doc_id IN (SELECT doc_id FROM cut) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN dropped.n IS NULL THEN d.text ELSE coalesce(kept.text, '') END AS text,
       CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS INTEGER) AS n_lines,
       CAST(coalesce(dropped.n, 0) AS INTEGER) AS n_dropped
FROM documents d LEFT JOIN dropped ON d.doc_id = dropped.doc_id LEFT JOIN kept ON d.doc_id = kept.doc_id
""")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the lines on eight sources or more cut out, unless no word would be left."""
    return line_dedup.dedup(common.documents(spark, sf_dir, "doc_id", "text", "source")).select(
        "doc_id", "text", "n_lines", "n_dropped")


@query("op5_decontamination")
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, literally or with other numbers and names."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.matches(common.documents(spark, sf_dir, "doc_id", "text"), items)


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir, "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.score(docs, toxicity.learn(docs, labels))


@query("op7_html_extraction")
def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet"))


def revisions(docs: DataFrame) -> DataFrame:
    """Three edits of every document, at places and of kinds that its id decides.

    A cut of up to 40 characters, an insertion of the document's source and language as a sentence, and a
    replacement of 12 characters by their own upper case.
    """
    n = F.length("text")
    at = lambda k: F.pmod(F.xxhash64("doc_id", F.lit(k)), n + 1)
    edits = F.array(
        F.struct(F.lit(0).alias("seq"), at(0).alias("at"), F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(41)).alias("size"), F.lit("").alias("text")),
        F.struct(F.lit(1).alias("seq"), at(1).alias("at"), F.lit(0).cast("bigint").alias("size"),
                 F.concat(F.lit(" See "), F.coalesce("source", F.lit("")), F.lit("/"), F.coalesce("lang", F.lit("")), F.lit(".\n")).alias("text")),
        F.struct(F.lit(2).alias("seq"), at(2).alias("at"), F.lit(12).cast("bigint").alias("size"),
                 F.upper(F.substring(F.col("text"), (at(2) + 1).cast("int"), F.lit(12))).alias("text")))
    return docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.inline(edits))


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after three edits of each."""
    import public_tokenizers

    docs = common.documents(spark, sf_dir, "doc_id", "text", "source", "lang")
    return token_counts.update(docs.select("doc_id", "text"), revisions(docs), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op11_license_scan", license_scan.oracle())
def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the licenses its text names or quotes."""
    return license_scan.scan(common.documents(spark, sf_dir, "doc_id", "text"))


@query("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults after damage, its cheapest repair and the repaired text's hash."""
    return conversation_repair.report(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet"))


@query("op13_hard_negatives", hard_negatives.ORACLE)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth embedding."""
    return hard_negatives.mine(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))

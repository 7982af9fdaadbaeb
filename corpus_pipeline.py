"""The training-data pipeline: quality rules, line dedup, near-duplicate join, decontamination, encoding.

Each stage takes the documents that the one before kept, and all but the last return the
columns of ``documents``; the last returns the encoded documents. Stages are written as Parquet in
the shared folder and read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import decontaminate, line_dedup, ngram_join, quality, sentencepieces
from lakeloom.llm.common import documents
from lakeloom.session import shared_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the production policy keeps."""
    return quality.keep(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the lines that are on eight sources or more."""
    return line_dedup.clean(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id."""
    return ngram_join.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its SentencePiece ids, their checksum, and whether decoding gave the text back."""
    import public_tokenizers

    return sentencepieces.round_trip(docs.select("doc_id", "text", "lang", "source"), public_tokenizers.path("piece_bpe_32k.model"), ids="ids")


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("sentencepiece", encoding_stage),
]

#: The encoder of the last stage has no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each written as Parquet and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Text embeddings from a fitted, stored pipeline: texts and later queries share one space.

The model is a Spark ML pipeline: words, counts over a vocabulary of the words that the most texts hold, inverse document
frequencies, unit length. It is fitted once on a table, saved, and loaded by whoever embeds; a query text gets its vector
from the same weights as the texts it is held against.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IDF, CountVectorizerModel, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators import vector as vx

_TEXT = "__text"


def _texts(df: DataFrame, text_col: str) -> DataFrame:
    return df.withColumn(_TEXT, F.coalesce(F.col(text_col), F.lit("")))


def vocabulary(df: DataFrame, text_col: str, size: int) -> list[str]:
    """The ``size`` words in the most texts, ties by the word (a bounded list for the driver)."""
    words = F.array_distinct(F.filter(F.split(F.lower(F.coalesce(text_col, F.lit(""))), r"\W+"), lambda w: w != ""))
    counts = df.select(F.explode(words).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    return [r["w"] for r in counts.orderBy(F.col("n").desc(), "w").limit(size).collect()]


def fit(df: DataFrame, text_col: str = "text", dims: int = 512) -> PipelineModel:
    """Vocabulary and document frequencies of all texts of ``df`` (null is an empty text)."""
    words = RegexTokenizer(inputCol=_TEXT, outputCol="__words", pattern=r"\W+", toLowercase=True)
    counts = CountVectorizerModel.from_vocabulary(vocabulary(df, text_col, dims), inputCol="__words", outputCol="__counts")
    counted = counts.transform(words.transform(_texts(df, text_col).select(_TEXT)))
    weights = IDF(inputCol="__counts", outputCol="__weights").fit(counted)
    return PipelineModel([words, counts, weights, Normalizer(inputCol="__weights", outputCol="__unit", p=2.0)])


def store(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def embed(model: PipelineModel, df: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """``id, content, embedding, status``; the status is empty if the text holds a word of the vocabulary."""
    out = model.transform(_texts(df.select(id_col, text_col), text_col))
    vector = vector_to_array("__unit")
    return out.select(F.col(id_col), F.col(text_col).alias("content"), vector.alias("embedding"),
                      F.when(F.exists(vector, lambda x: x != 0), F.lit("")).otherwise(F.lit("NO_KNOWN_WORD")).alias("status"))


def similar_texts(model: PipelineModel, base: DataFrame, queries: DataFrame, query_id: str, query_text: str, base_id: str = "doc_id",
                  k: int = 5, decimals: int = 9) -> DataFrame:
    """``query_id, id, content, score, rank``: the ``k`` texts of an embedded ``base`` nearest to each query text.

    ``base`` is the output of :func:`embed`. Texts that share no word with a query aren't returned.
    """
    asked = embed(model, queries, query_id, query_text).where("status = ''")
    known = base.where("status = ''")
    hits = vx.vector_search(known, asked, k, base_id=base_id, query_id=query_id, blocked=True, decimals=decimals).where("score > 0")
    contents = known.select(F.col(base_id).cast("bigint").alias("vec_id"), "content")
    return hits.join(contents, "vec_id").select("query_id", F.col("vec_id").alias("id"), "content", "score", "rank")

"""Small helpers shared by the training-data operators.

Scratch tables live in the folder that ``spark.checkpoint.dir`` names (``session.shared_dir``):
a written table cuts lineage and survives the loss of the executors that made it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.session import shared_dir

#: Java regular expression of one run of the six ASCII white-space characters.
SPACES = "[\\x20\\x09-\\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != F.lit(""))


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return df.select(*columns) if columns else df


def temp_names(df: DataFrame, *names: str) -> list[str]:
    """Column names starting with ``names`` that ``df`` does not have (case ignored, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out

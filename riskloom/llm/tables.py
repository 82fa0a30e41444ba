"""Reading the text tables, and folders for what a query sets down on the way."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import scratch_path

# The declared columns of `documents`, in order.
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id long, text string) of a table; other columns, whatever their names, are left behind."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def set_down(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back.

    The lineage ends there: a lost executor costs a read, not the work before.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

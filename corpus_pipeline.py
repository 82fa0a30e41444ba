"""From raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and returns the columns of
`documents`; the last returns one row for each piece with its place in a sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import jaccard, leaks, ordinal, packing, secrets
from riskloom.llm.queries import RANKS, TOKENIZER
from riskloom.llm.tables import read, set_down

ORACLE_SQL = None  # no stage can be written in SQL; tests/llm/test_pipeline.py checks the rows against plain Python


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier rejects go."""
    return ordinal.sound(docs, read(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked documents the one with the smallest id stays."""
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return leaks.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    return secrets.redact(docs, RANKS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = set_down(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

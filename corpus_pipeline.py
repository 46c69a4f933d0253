"""From documents to packed training sequences, in stages that each read what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from intentloom.llm import minhash, mix, packing, quality, secrets
from intentloom.session import through_table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their own rules and their host's verdict keep."""
    return quality.good_documents(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash.distinct_documents(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret masked."""
    return secrets.masked_documents(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources drawn to their target weights; a document drawn twice is there twice."""
    return mix.mix_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its sequence and place there."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality rules", good),
    ("MinHash near-dedup", distinct),
    ("secret scans", without_secrets),
    ("mixing to target weights", mixed),
    ("best-fit packing", packed),
]

#: Tokens and packing have no SQL form; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = through_table(docs, f"stage{k}")
    return docs

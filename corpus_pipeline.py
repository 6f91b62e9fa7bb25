"""The training-data pipeline: documents through the stages in order, each written and read again.

Every stage but the last returns the columns of ``documents``; rows leave or change, columns do not. Rows with a null
``doc_id`` are judged by their own text in every stage after the first.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from granary.llm import decontamination, jaccard_join, packing, quality, secret_scan
from granary.llm.tables import table
from granary.session import materialise


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. It learns from the labelled documents of this stage's input.

    Null and empty texts are scored as the empty text, long ones whole; rows that repeat an id are judged each by its own text, and an
    empty table stays empty.
    """
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by the Jaccard join the one with the least id; a repeated row of it stays once."""
    table(spark, sf_dir, "documents")  # the session's settings
    return jaccard_join.without_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontamination.rows_without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    table(spark, sf_dir, "documents")
    return secret_scan.masked_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents and their places in the training sequences.

    A null or empty text is its end mark alone; rows with a null or repeated id are packed like others.
    """
    table(spark, sf_dir, "documents")
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("best-fit packing", packed),
]

#: Trained models and tokenizers are beyond SQL; ``tests/llm`` compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

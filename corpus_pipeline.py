"""A corpus pipeline: toxicity, exact and near deduplication, mixing, encoding.

Every stage takes all its predecessor kept and returns the columns of
``documents``; the last returns the encoded texts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from earshot.llm import bpe, exact_dedup, mixing, queries, simhash, toxicity
from earshot.session import stage


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    return toxicity.reject_toxic(docs, queries.toxicity_model(spark, docs, sf_dir))


def drop_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints of 3-word shingles with at most 3 differing bits."""
    return simhash.drop_near_duplicates(docs, words_per_shingle=3, radius=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return bpe.encode(docs, public_tokenizers.path(queries.VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_duplicates),
    ("SimHash near dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("encoding", encode),
]

# fingerprints and byte pairs have no SQL form; the tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stage(docs, "pipeline")
    return docs

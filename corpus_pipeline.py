"""The corpus pipeline: stages over ``documents``, each written as Parquet before the next reads it.

Quality rules, exact deduplication, near-deduplication, mixing of sources, and encoding.  A
stage works on all that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rungworks.llm import bpe, exact, minhash, mixing, quality
from rungworks.llm.queries import rank_file
from rungworks.session import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality.keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose shingles are alike by four fifths or more."""
    return minhash.keep_one_of_each(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: what the sources' quotas take of each document, a row for each copy."""
    return mixing.mixture(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and where each token ends, checked by decoding."""
    coded = bpe.encode_and_decode(docs, rank_file())
    return bpe.digests(coded).drop("decoded", "text", "n_chars")


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("byte_bpe", byte_bpe),
]

#: Connected components of near copies and byte-level BPE are beyond SQL; the tests compare
#: with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the folder's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

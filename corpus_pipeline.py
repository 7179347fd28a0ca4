"""From raw documents to packed training sequences: toxicity, quality rules, near-duplicates, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written as Parquet and read again as
the ``docs`` of the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import packing, quality_rules, simhash, toxicity
from lakeloom.session import cut


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.3."""
    return toxicity.clean(docs, _labels(spark, sf_dir), 0.3)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules and the n-gram ratio."""
    return quality_rules.accepted(docs, _labels(spark, sf_dir))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints (four-word shingles) link at four differing bits or fewer."""
    return simhash.deduplicate(docs, width=4, radius=4)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, placed in sequences of at most 4,096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("quality_rules", drop_poor), ("simhash_near_dedup", drop_near_copies), ("packing", pack)]

# Word lists are learned and texts are tokenized, which SQL cannot say; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

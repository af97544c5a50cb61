"""From raw documents to shuffled training shards.

Each stage takes (spark, docs, sf_dir), is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chatterlens.llm import decontaminate, mixing, near_dedup, quality_rules, sharding
from chatterlens.llm._tables import read, store


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within their compression band that pass the base rules."""
    return quality_rules.keep_in_band(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each group; five-word shingles, similarity 0.8."""
    return near_dedup.first_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a twentieth of their words in benchmark passages."""
    return decontaminate.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source schedule takes them, which may be never or up to three times."""
    return mixing.repeated(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and slot."""
    return sharding.shuffled(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("sharding", shards),
]

# Compression ratios, signatures and seeded hashes have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

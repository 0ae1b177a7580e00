"""From raw documents to token digests: quality, exact and near duplicates, mixing, BPE.

Each stage takes what its predecessor kept, whole, and all but the last return the columns of
``documents``. A document that the mix takes twice comes out twice.

In every stage nulls may be in any column, texts may be empty or very long, rows may be repeated or
tie, the table may be empty, and there may be further columns of any name, which are kept as they
are. What each stage does with them is said there and in the operator that it calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daygauge.llm import mixing, near_dup, quality, recipes
from daygauge.llm.queries import bpe_digests
from daygauge.llm.workspace import ship, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or are far out in their language and source.

    Null and empty texts go; a null language or source is one of each; repeated rows go or stay together.
    """
    ship(spark)
    return quality.good_documents(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of equal texts.

    A null text equals an empty one. The longest original stays, then the smallest id, null last; of
    repeated rows one.
    """
    ship(spark)
    return recipes.without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component of near-duplicates.

    The smallest id stays, null last; of repeated rows one. Texts without words are linked with nothing.
    """
    ship(spark)
    return near_dup.without_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents by the sources' weights, some of them twice.

    A null source is one of its own; texts without words cost the mix nothing; equal rows are taken alike.
    """
    ship(spark)
    return mixing.mixed(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode and decode what is left: doc_id, n_tokens, ids_sha256, decoded_sha256.

    A null or empty text has no tokens; a null id stays null; each row, also a repeated one, has its row.
    """
    ship(spark)
    return bpe_digests(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode_texts", encode_texts),
]

# Near-duplicates and BPE are not expressed in SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each but the last is stored in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

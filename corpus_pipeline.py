"""A training-data pipeline over `documents`: language, copies, near copies, mix, sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
`documents`. run() writes every stage as a table under spark.checkpoint.dir and reads it again, so a lost
executor repeats at most one stage. Null and empty texts leave at the language stage; an empty table
passes through as empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.durable import Scratch
from tallyloom.llm import exact_dedup, language_id, mixing, packing, simhash


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages."""
    return language_id.in_a_language(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, one row for each document and round."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return packing.pack(docs)


STAGES = [
    ("language", keep_known_languages),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: A learned model, 64-bit fingerprints and token ids are beyond SQL; tests hold every stage against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

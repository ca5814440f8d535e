"""Corpus preparation in five stages, each one of the corpus operators.

Each stage gets the rows that its predecessor kept, read from Parquet, and
returns the columns of ``documents``; the last returns the mix: which
documents, in which epoch, with how many tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgermatch.llm import decontaminate, exact_dedup, queries, simhash, toxicity
from ledgermatch.session import scratch_path


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity model rejects go. It learns from the labels of
    the rows that are here, outside the held-out fifth."""
    return toxicity.keep_clean(docs, queries.toxicity_model(spark, docs, sf_dir))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest identifier stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints, the row with the smallest identifier stays."""
    return simhash.drop_near_duplicates(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which a benchmark item occurs within its error budget go."""
    return decontaminate.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Half of the remaining tokens, by the production weights."""
    return queries.mix_documents(docs)


STAGES = [
    ("toxicity", clean_language),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("source_mix", mix_sources),
]

#: a trained model and a hash of shingles are beyond SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is a table in the shared folder."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Corpus pipeline: quality rules, near-duplicates, secrets, source mix, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that the runner
writes as Parquet and reads again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hexvault.llm import mixing, packing, quality_rules, secret_scan, simhash
from hexvault.llm.common import stored, table
from hexvault.llm.queries import vocabulary_files


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; boilerplate lines are taken out of the rest."""
    return quality_rules.cleaned(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id."""
    return simhash.representatives(docs, shingle=3, max_bits=3)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret values are masked; no document goes."""
    return secret_scan.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are read up to twice; every document is read at least once."""
    return mixing.mixed(docs, max_repeats=2.0, budget="cover")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs, vocabulary_files())


STAGES = [("quality_rules", clean), ("simhash", deduplicate), ("secret_scan", hide_secrets),
          ("mixing", mix), ("packing", pack)]

#: Fingerprints and token ids have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

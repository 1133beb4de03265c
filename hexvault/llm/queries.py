"""Registered queries of the training-data operators, over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexvault.llm import (
    ann, fill_middle, filter_audit, mixing, packing, pii, quality_cnn, quality_rules, secret_scan, simhash,
    substring_dedup, suffix_dedup, warc)
from hexvault.llm.common import table
from hexvault.llm.oracles import ORACLES  # noqa: F401

#: Public vocabulary used by the packing query.
VOCABULARY = "byte_bpe_50k"


def vocabulary_files() -> tuple[str, str, str]:
    import public_tokenizers
    return (public_tokenizers.path(f"{VOCABULARY}.json"), public_tokenizers.path(f"{VOCABULARY}.tiktoken"),
            public_tokenizers.PATTERN)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document with their corpus-wide ownership verdicts."""
    return secret_scan.secret_spans(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word statistics and the verdict by cross-document line frequency."""
    return quality_rules.verdicts(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.components(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest of every fiftieth vector among all vectors."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), query_every=50, k=5)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of the documents at 95 % of the largest entropy, at most four readings a source."""
    return mixing.mixture(table(spark, sf_dir, "documents"), entropy_share=0.95, max_repeats=4.0,
                          budget="corpus", block_tokens=1 << 13)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through WARC records in ZIP archives and back."""
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op7_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by the byte-level network."""
    return quality_cnn.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document left after repeated 20-word windows are removed."""
    return substring_dedup.deduplicated(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed into sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary_files())


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, plain and disguised."""
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survivors, removals, redundancies and label losses of five filters in all 120 orders."""
    return filter_audit.interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its middle moved to the end, and the text restored from that."""
    out = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document left after repeated 200-byte strings are removed."""
    return suffix_dedup.deduplicated(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_secret_scan, op2_quality_rules, op3_simhash, op4_nearest, op5_mixing, op6_warc, op7_quality_cnn,
    op8_substring_dedup, op9_packing, op10_pii, op11_filter_audit, op12_fill_middle,
    op13_suffix_dedup)}

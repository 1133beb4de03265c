"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexvault.session import checkpoint_path

#: White space as the word rule ``[^\x20\x09-\x0D]+`` sees it (fixed values).
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared checkpoint directory and read it back.

    Cuts lineage durably: a lost executor re-reads the files, and row numbers given
    with ``monotonically_increasing_id`` are frozen from here on.
    """
    spark = df.sparkSession
    path = checkpoint_path(spark, f"{tag}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """``docs`` as ``doc`` (all its columns) and ``k0, k1, ...``, with texts as ``text_key`` does."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       *[F.col(c).alias(f"k{i}") for i, c in enumerate(columns[:-1])],
                       text_key(columns[-1]).alias(f"k{len(columns) - 1}"))


def text_key(text: str) -> Column:
    """64 bits that stand for a text beside its id: rows equal in both are one document."""
    return F.xxhash64(F.col(text))


def by_key(left: DataFrame, right: DataFrame, keys: int, how: str = "inner") -> DataFrame:
    """Null-safe join on ``k0 ..``; ``right`` keeps its other columns only."""
    names = [f"k{i}" for i in range(keys)]
    right = right.select(*[F.col(n).alias(f"_r{n}") for n in names], *[c for c in right.columns if c not in names])
    cond = F.lit(True)
    for n in names:
        cond = cond & left[n].eqNullSafe(right[f"_r{n}"])
    joined = left.join(right, cond, how)
    return joined if how == "left_semi" else joined.drop(*[f"_r{n}" for n in names])


def unpack(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(f"doc.`{c}`").alias(c) for c in columns])


def with_text(df: DataFrame, columns: list[str], text: str, new: Column, length: str) -> DataFrame:
    """``columns`` of ``doc`` with a new text; ``length`` (if it is a column) follows it."""
    kind = df.schema["doc"].dataType
    out = df.withColumn("doc", F.col("doc").withField(f"`{text}`", new))
    if length in columns:
        size = F.length(F.col(f"doc.`{text}`")).cast(kind[length].dataType)
        out = out.withColumn("doc", F.col("doc").withField(f"`{length}`", size))
    return unpack(out, columns)


def salted_lookup(rows: DataFrame, lookup: DataFrame, on: list[str], row_id: str,
                  how: str = "inner", salts: int = 16) -> DataFrame:
    """Join many ``rows`` to at most one ``lookup`` row per key, with the key salted.

    A key that holds a third of all rows is spread over ``salts`` partitions; the
    lookup side (one row per key) is repeated ``salts`` times. Null keys match null.
    Spark sizes that side as if it came once, so the join is merged by hint: a
    broadcast would bring all repeats of the whole lookup to the driver.
    """
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(row_id), F.lit(salts)).cast("int"))
    right = lookup.select(*[F.col(c).alias(f"_k_{c}") for c in on],
                          *[c for c in lookup.columns if c not in on],
                          F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt_k"))
    cond = left["_salt"] == right["_salt_k"]
    for c in on:
        cond = cond & left[c].eqNullSafe(right[f"_k_{c}"])
    return left.join(right.hint("merge"), cond, how).drop("_salt", "_salt_k", *[f"_k_{c}" for c in on])


def words_of(text: Column) -> Column:
    """Words of a text as an array (empty for null or blank text)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, BLANK_RUN, -1))

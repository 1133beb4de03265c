"""Table maintenance jobs: compaction sorted by cell, day partitioning, post-failure checks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexvault.operators import quality as Q

TARGET_FILE_MB = 256


def input_bytes(df: DataFrame) -> int:
    """Total size of the files behind a file-source DataFrame (from scan metadata)."""
    row = df.select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.sum("file_size")).first()
    return int(row[0] or 0)


def compact(spark: SparkSession, src: str, dst: str, sort_col: str = "h3_res9",
            target_mb: int = TARGET_FILE_MB) -> str:
    """Rewrite a parquet table into ~``target_mb`` files range-clustered by ``sort_col``
    (neighbouring cells share files, so min/max statistics prune cell filters)."""
    df = spark.read.parquet(src)
    n = max(1, math.ceil(input_bytes(df) / (target_mb * 1024 * 1024)))
    (df.repartitionByRange(n, F.col(sort_col)).sortWithinPartitions(sort_col)
       .write.mode("overwrite").parquet(dst))
    return dst


#: Bits of each column in a space-filling key.
Z_BITS = 10


def z_order(df: DataFrame, columns: list[str], bits: int = Z_BITS) -> Column:
    """Position of a row on a Z-order curve over ``columns`` (numbers, dates or timestamps).

    Every column is cut into ``2 ** bits`` equal steps between its smallest and largest
    value, taken from one aggregate, and the bits of the steps are interleaved. Nulls
    stand in the first step.
    """
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    number = {c: (F.unix_micros(F.col(c).cast("timestamp")) if kinds[c] in ("timestamp", "timestamp_ntz", "date")
                  else F.col(c)).cast("double") for c in columns}
    ends = df.agg(*[f(number[c]).alias(f"{n}{i}") for i, c in enumerate(columns)
                    for n, f in (("lo", F.min), ("hi", F.max))]).first()
    out = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        lo, hi = ends[f"lo{i}"], ends[f"hi{i}"]
        if lo is None or hi == lo:
            continue
        top = (1 << bits) - 1
        step = F.least(F.floor((number[c] - lo) / (hi - lo) * (top + 1)), F.lit(top))
        step = F.coalesce(step, F.lit(0)).cast("long")
        for b in range(bits):
            bit = F.shiftright(step, b).bitwiseAND(1)
            out = out.bitwiseOR(F.shiftleft(bit, b * len(columns) + i))
    return out


def cluster(df: DataFrame, columns: list[str], files: int) -> DataFrame:
    """Rows in ``files`` ranges of the curve, so that each file covers a small box of all columns."""
    key = df.withColumn("_z", z_order(df, columns))
    # Equal keys may be cut between files: a hot cell and hour is spread.
    return key.repartitionByRange(files, "_z", F.rand(7)).sortWithinPartitions("_z").drop("_z")


def write_day_partitioned(df: DataFrame, path: str, batch_id: int = 0, ts_col: str = "load_date",
                          clustered_by: list[str] | None = None, files_per_batch: int = 1) -> str:
    """Write a batch of a vault table under ``load_day=…/batch=…`` (UTC day of ``ts_col``).

    Only the folders of this batch are overwritten, so a replay of a batch id doubles
    nothing. ``clustered_by`` orders the rows on a space-filling curve, so that the file
    statistics of all its columns are narrow.
    """
    if clustered_by:
        df = cluster(df, clustered_by, files_per_batch)
    (df.withColumn("load_day", F.to_date(ts_col)).withColumn("batch", F.lit(int(batch_id)))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("load_day", "batch").parquet(path))
    return path


def post_failure_checks(vault, log: DataFrame | None = None, messages: int | None = None) -> DataFrame:
    """Assertions after a restarted stream: hub keys map 1:1 to business keys, links
    point to hubs, satellite rows equal log rows, and nothing was lost."""
    spark = vault["hub_user"].sparkSession
    from hexvault.plans.models import Models
    m = Models(vault)
    rows = []
    for t in (Q.Test("unique", "stg_users", "hk_user_id"), Q.Test("unique", "stg_merchants", "hk_merchant_id"),
              Q.Test("unique", "stg_couriers", "hk_courier_id")):
        rows.append((t.name, Q.violations(t, m).count()))
    for t in [t for t in Q.DECLARED_TESTS if t.kind == "relationships"]:
        rows.append((t.name, Q.violations(t, m).count()))
    sat = vault["sat_interaction_context_spatial"].count()
    if log is not None:
        rows.append(("satellite_rows_equal_log_rows", abs(sat - log.count())))
    if messages is not None:
        rows.append(("no_message_lost", abs(sat - messages)))
    return spark.createDataFrame(rows, "check string, violations long")

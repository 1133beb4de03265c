"""Session construction and cluster-aware settings.

The library never hard-codes a machine-local scratch path on a cluster: the
checkpoint directory is read from ``spark.checkpoint.dir`` of the running
session and only filled in when it is unset (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC wall clock (vault timestamps are UTC,
# time-zone-less), AQE for runtime coalescing / skew splitting, ANSI mode left on.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "hexvault", extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the library's required settings."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared, durable folder; it is
    used as is. Only a local session without it (tests, laptops) gets a fresh temp
    dir; on a cluster a missing setting is an error.
    """
    context = spark.sparkContext
    already = context._jsc.sc().getCheckpointDir()
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if already.isDefined():  # the caller's own folder stays
            return already.get()
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        current = tempfile.mkdtemp(prefix="hexvault-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not already.isDefined():
        context.setCheckpointDir(current)
    return current


def checkpoint_path(spark: SparkSession, *parts: str) -> str:
    """A sub-folder of the shared checkpoint directory (for stream checkpoints)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, *parts)


#: Shuffle partitions that go into one file of a stored frame of few bytes a row.
NARROW = 8


def narrowed(df: DataFrame) -> DataFrame:
    """Rows of a few bytes in fewer partitions than whole documents take, but one for each core at least.

    For frames of a key or two that are stored: every partition is a file of its own.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions")) // NARROW
    return df.coalesce(max(parts, spark.sparkContext.defaultParallelism))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable (not local) checkpoint: survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)

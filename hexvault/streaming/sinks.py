"""Sinks for the streaming vault job: append tables, keyed live table, batch-id idempotency.

There is no table format with MERGE on the classpath, so every sink writes plain
parquet under a folder per micro-batch id (``batch=<id>``). Re-running a batch id
overwrites exactly that folder, so a restarted query that replays its last batch
never duplicates rows (exactly-once output on top of the checkpoint). A batch counts
for readers once all its tables are written (``commit_batch``); folders are found
through Spark's file systems, so any store that Spark reads will do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexvault.operators.marts import latest_by
from hexvault.sources import files

LIVE_TIE_BREAK = ["status", "latitude", "longitude", "speed_kmh", "bearing_deg", "h3_res7", "h3_res9"]
LIVE_COLUMNS = ["hk_courier_id", "courier_id", "latitude", "longitude", "speed_kmh", "bearing_deg",
                "status", "h3_res7", "h3_res9", "event_ts_ms"]
LIVE_TABLE, COMMITS = "courier_telemetry_live", "commits"
#: Finished versions of a bucket that stay for readers, and buckets of the live table.
KEPT_VERSIONS, LIVE_BUCKETS = 3, 32


def latest_live_rows(rows: DataFrame) -> DataFrame:
    """Latest row per courier by ``event_ts_ms`` (ties: status, lat, lon, … ascending).

    Arrival order is not total across partitions of a micro-batch, so the live
    table keeps the latest *event time* with a deterministic tie-break.
    """
    with_ts = rows.withColumn("_ts", F.timestamp_millis(F.col("event_ts_ms")))
    out = latest_by(with_ts, "hk_courier_id", "_ts", LIVE_TIE_BREAK, ["hk_courier_id", *LIVE_COLUMNS[1:]])
    return out.select(*LIVE_COLUMNS)


def _batch(batch_id: int) -> str:
    return f"batch={int(batch_id):012d}"


def append_batch(df: DataFrame, root: str, table: str, batch_id: int) -> str:
    """Write one micro-batch of an append-only table under ``root/table/batch=<id>``."""
    path = f"{root}/{table}/{_batch(batch_id)}"
    df.write.mode("overwrite").parquet(path)
    return path


def commit_batch(spark, root: str, topic: str, batch_id: int) -> None:
    """Record that every table of the topic holds this batch."""
    marker = spark.range(1).select(F.lit(int(batch_id)).cast("long").alias("batch_id"))
    marker.coalesce(1).write.mode("overwrite").parquet(f"{root}/{COMMITS}/{topic}/{_batch(batch_id)}")


def committed_batches(spark, root: str, topic: str) -> list[str]:
    """Names of the committed batches of a topic; raises if there is none."""
    found = files.committed_children(spark, f"{root}/{COMMITS}/{topic}", "batch=")
    if not found:
        raise FileNotFoundError(f"no committed batch of {topic} under {root}")
    return found


def read_batches(spark, root: str, table: str, schema, batches: list[str]) -> DataFrame:
    """An append-only table at the given batches."""
    return files.read_folders(spark, [f"{root}/{table}/{b}" for b in batches], schema)


def read_appended(spark, root: str, table: str, schema) -> DataFrame:
    """All finished batches of a table that need not exist (empty frame with the schema when absent)."""
    names = files.committed_children(spark, f"{root}/{table}", "batch=")
    return read_batches(spark, root, table, schema, names)


def bucket_of(key: str, buckets: int):
    """Bucket of a key: its hash."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def held_buckets(spark, base: str, before: int | None = None) -> dict[int, list[str]]:
    """Folders ``v=<version>/_b=<bucket>`` of each bucket, oldest first, in finished versions (before one)."""
    held: dict[int, list[str]] = {}
    for v in files.committed_children(spark, base, "v="):
        if before is None or int(v.split("=")[1]) < before:
            for d in files.children(spark, f"{base}/{v}"):
                if d.startswith("_b="):
                    held.setdefault(int(d.split("=")[1]), []).append(f"{base}/{v}/{d}")
    return held


def upsert_buckets(spark, base: str, batch: DataFrame, version: int, key: str, buckets: int, latest,
                   kept: int = KEPT_VERSIONS, schema=None) -> str:
    """Keyed upsert that rewrites the buckets of the batch's keys only.

    ``latest`` reduces rows (with their bucket ``_b``) to one per key. A bucket is written
    anew from its newest finished version before ``version`` and the batch, so running a
    version again gives the same table. A bucket keeps ``kept`` versions; folders of versions
    that hold no bucket any more go, so there are at most ``kept`` folders a bucket.
    """
    rows = batch.withColumn("_b", bucket_of(key, buckets))
    touched = sorted(r[0] for r in rows.select("_b").distinct().collect())  # at most `buckets` ints
    held = held_buckets(spark, base, version)
    prior = [held[b][-1] for b in touched if b in held]
    if prior:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        old = reader.parquet(*prior).select(*batch.columns).withColumn("_b", bucket_of(key, buckets))
        rows = old.unionByName(rows)
    path = f"{base}/v={int(version):012d}"
    latest(rows).repartition("_b").write.mode("overwrite").partitionBy("_b").parquet(path)
    for b in touched:
        for old in held.get(b, [])[:-(kept - 1) or None]:
            files.delete(spark, old)
    for v in files.committed_children(spark, base, "v="):
        if int(v.split("=")[1]) < version and not any(d.startswith("_b=") for d in files.children(spark, f"{base}/{v}")):
            files.delete(spark, f"{base}/{v}")
    return path


def read_buckets(spark, base: str, schema=None) -> DataFrame:
    """Every bucket at its newest finished version; raises if no version is finished."""
    if not files.committed_children(spark, base, "v="):
        raise FileNotFoundError(f"no finished version under {base}")
    paths = [p[-1] for _, p in sorted(held_buckets(spark, base).items())]
    if not paths and schema is not None:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*paths)


def upsert_live(spark, root: str, batch: DataFrame, batch_id: int, schema, buckets: int = LIVE_BUCKETS) -> str:
    """Keyed upsert of the live table: the latest row per courier, in the buckets that the batch touches.

    Writes the version folder ``v=<batch_id>``; readers take each bucket's newest finished
    one, so an interrupted write leaves the old rows visible. Re-running a batch id starts
    from the versions before it.
    """
    def latest(rows: DataFrame) -> DataFrame:
        return latest_live_rows(rows).withColumn("_b", bucket_of("hk_courier_id", buckets))

    return upsert_buckets(spark, f"{root}/{LIVE_TABLE}", batch.select(*LIVE_COLUMNS), batch_id, "hk_courier_id",
                          buckets, latest, schema=schema)


def read_live(spark, root: str, schema) -> DataFrame:
    """The live table at the newest finished version of each bucket; raises if there is none."""
    return read_buckets(spark, f"{root}/{LIVE_TABLE}", schema)


def ensure_table(spark, root: str, name: str, schema) -> str:
    """CREATE TABLE IF NOT EXISTS: an empty parquet folder with the declared schema."""
    path = f"{root}/{name}"
    if not files.children(spark, path):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/batch=init")
    return path


def live_point_read(spark, root: str, schema, n: int = 5) -> DataFrame:
    """Projection of the live table with a small limit (a point-read probe)."""
    return read_live(spark, root, schema).select("courier_id", "status", "h3_res7", "event_ts_ms").limit(n)

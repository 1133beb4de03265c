"""Streaming feature jobs (designed operators) on Structured Streaming.

* ``bronze_envelope`` – raw message + source position + ingest time, append only.
* ``dedup_within_watermark`` – drop replays seen within a 24 h bounded state.
* ``windowed_counts`` – sliding/tumbling counts with a watermark of delay +
  allowed lateness (update mode: stragglers update their window; rows beyond the
  lateness are dropped by the engine and counted in the query progress).
* ``session_dwell_stream`` – per-user session windows (30 min gap) with mean dwell.
* ``ctr_stream`` – item CTR over 1 h windows sliding by 5 min.
* ``impression_click_join`` – stream-stream left outer join with a time bound.
* ``FeatureSink`` / ``EmbeddingSink`` – idempotent key upserts from ``foreachBatch``
  (a replayed batch id rewrites the same version; values are SET, never added);
  ``BucketedFeatureSink`` rewrites only the key-hash buckets a batch touches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexvault.operators.features import CLICK_ATTRIBUTION_S, CTR_SLIDE, CTR_WINDOW, SESSION_GAP_S
from hexvault.sources import files
from hexvault.streaming import sinks

DEDUP_STATE = "24 hours"
FEATURE_WATERMARK = "15 seconds"
ALLOWED_LATENESS = "5 minutes"


def _ts(df: DataFrame) -> DataFrame:
    return df if "event_time_ltz" in df.columns else df.withColumn("event_time_ltz", F.timestamp_millis("event_ts_ms"))


def bronze_envelope(raw: DataFrame, topic: str) -> DataFrame:
    """Envelope rows: id, topic, partition, offset, ingest time, payload.

    From Kafka the position columns are native; from a file source the file path
    stands in for the partition and the row's byte position is not available, so
    the offset is the payload hash (stable across replays of the same file).
    """
    cols = raw.columns
    if {"partition", "offset"} <= set(cols):
        part, off = F.col("partition").cast("string"), F.col("offset")
        payload = F.col("value").cast("string")
    else:
        part = F.col("_metadata.file_path")
        payload = F.col("value")
        off = F.xxhash64(payload)
    return raw.select(F.sha2(F.concat_ws("|", F.lit(topic), part, off.cast("string")), 256).alias("envelope_id"),
                      F.lit(topic).alias("topic"), part.alias("partition_id"), off.alias("source_offset"),
                      F.current_timestamp().alias("ingest_ts"), payload.alias("payload_json"))


def dedup_within_watermark(events: DataFrame, keys: list[str], state: str = DEDUP_STATE) -> DataFrame:
    """Drop duplicates of ``keys`` seen within the bounded state; later replays may pass
    (the daily batch ``distinct`` in staging removes those)."""
    return _ts(events).withWatermark("event_time_ltz", state).dropDuplicatesWithinWatermark(keys)


def windowed_counts(events: DataFrame, key: str, window: str = "1 minute", slide: str | None = None,
                    delay: str = FEATURE_WATERMARK, lateness: str = ALLOWED_LATENESS) -> DataFrame:
    """Counts per key and event-time window; watermark = delay + allowed lateness."""
    wm = f"{_seconds(delay) + _seconds(lateness)} seconds"
    e = _ts(events).withWatermark("event_time_ltz", wm)
    w = F.window("event_time_ltz", window, slide) if slide else F.window("event_time_ltz", window)
    return e.groupBy(F.col(key), w.alias("w")).agg(F.count(F.lit(1)).alias("events")) \
            .select(key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "events")


def _seconds(text: str) -> int:
    n, unit = text.split()
    return int(n) * {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600}[unit]


def session_dwell_stream(events: DataFrame, gap_s: int = SESSION_GAP_S, delay: str = FEATURE_WATERMARK) -> DataFrame:
    """Per-user session windows (gap ``gap_s``) with event count and mean dwell."""
    e = _ts(events).withWatermark("event_time_ltz", delay)
    return (e.groupBy("user_id", F.session_window("event_time_ltz", f"{gap_s} seconds").alias("s"))
             .agg(F.count(F.lit(1)).alias("events"), F.avg("dwell_time_ms").alias("session_dwell"))
             .select("user_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                     "events", "session_dwell"))


def ctr_stream(events: DataFrame, delay: str = FEATURE_WATERMARK) -> DataFrame:
    """Item impressions, clicks and CTR over 1 h windows sliding by 5 minutes."""
    e = _ts(events).withWatermark("event_time_ltz", delay)
    g = e.groupBy("item_id", F.window("event_time_ltz", CTR_WINDOW, CTR_SLIDE).alias("w")).agg(
        F.sum((F.col("event_type") == "view_item").cast("long")).alias("impressions"),
        F.sum((F.col("event_type") == "click").cast("long")).alias("clicks"))
    return g.select("item_id", F.col("w.start").alias("window_start"), "impressions", "clicks",
                    (F.col("clicks") / F.nullif(F.col("impressions"), F.lit(0))).alias("ctr"))


def impression_click_join(impressions: DataFrame, clicks: DataFrame, within_s: int = CLICK_ATTRIBUTION_S,
                          delay: str = FEATURE_WATERMARK) -> DataFrame:
    """Stream-stream left outer join on (user, item) with ``click ∈ [imp, imp + within]``.

    Each impression is emitted once: label 1 with its first matching click, or label 0
    when its window closes. The join emits a row per click; an aggregation keyed by the
    impression and its event time reduces them, and is closed by the watermark, so the
    state of both steps is bounded.
    """
    i = _ts(impressions).select(F.col("event_id").alias("imp_id"), F.col("user_id").alias("imp_user"),
                                F.col("item_id").alias("imp_item"), F.col("event_time_ltz").alias("imp_ts")) \
        .withWatermark("imp_ts", delay)
    c = _ts(clicks).select(F.col("user_id").alias("clk_user"), F.col("item_id").alias("clk_item"),
                           F.col("event_time_ltz").alias("clk_ts")).withWatermark("clk_ts", delay)
    cond = ((F.col("imp_user") == F.col("clk_user")) & (F.col("imp_item") == F.col("clk_item"))
            & (F.col("clk_ts") >= F.col("imp_ts"))
            & (F.col("clk_ts") <= F.col("imp_ts") + F.expr(f"INTERVAL {within_s} SECONDS")))
    # The click time goes on as a plain number: the impression time alone carries the watermark.
    pairs = i.join(c, cond, "leftOuter").select("imp_id", "imp_user", "imp_item", "imp_ts",
                                                 F.unix_micros("clk_ts").alias("clk_us"))
    first = pairs.groupBy("imp_id", "imp_user", "imp_item", "imp_ts").agg(F.min("clk_us").alias("clk_us"))
    return first.select("imp_id", "imp_user", "imp_item", "imp_ts", F.timestamp_micros("clk_us").alias("clk_ts"),
                        F.col("clk_us").isNotNull().cast("int").alias("label"))


class FeatureSink:
    """Idempotent feature upsert: each batch writes a new version = previous ∪ batch,
    latest value per key by ``version_col`` (SET semantics). Replaying a batch id
    starts again from the version before it, so the result is identical. Only versions
    that Spark has finished count, and ``KEPT`` of them stay."""

    KEPT = 3

    def __init__(self, root: str, key: str, version_col: str, value_cols: list[str]):
        self.root, self.key, self.version_col, self.value_cols = root, key, version_col, value_cols

    def _path(self, version: int) -> str:
        return f"{self.root}/v={version:012d}"

    def _versions(self, spark) -> list[int]:
        return [int(n.split("=")[1]) for n in files.committed_children(spark, self.root, "v=")]

    def read(self, spark, schema: str | None = None) -> DataFrame:
        """The newest finished version; raises if there is none."""
        vs = self._versions(spark)
        if not vs:
            raise FileNotFoundError(f"no finished version under {self.root}")
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(self._path(vs[-1]))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        from hexvault.operators.marts import latest_by
        spark = batch.sparkSession
        prior = [v for v in self._versions(spark) if v < batch_id]
        cols = [self.key, self.version_col, *self.value_cols]
        rows = batch.select(*cols)
        if prior:
            rows = spark.read.parquet(self._path(prior[-1])).select(*cols).unionByName(rows)
        rows = rows.withColumn("_t", F.timestamp_micros(F.col(self.version_col).cast("long")))
        latest = latest_by(rows, self.key, "_t", [], cols)
        latest.write.mode("overwrite").parquet(self._path(batch_id))
        for v in prior[:-(self.KEPT - 1)]:
            files.delete(spark, self._path(v))


class BucketedFeatureSink(FeatureSink):
    """``FeatureSink`` whose table is split into ``buckets`` by key hash; a micro-batch
    rewrites only the buckets it touches (``v=<batch>/_b=<bucket>``), so the cost of
    a batch follows the keys it carries, not the whole table. Readers take, per
    bucket, the newest finished version folder holding it. Replays stay idempotent: a
    batch id is rebuilt from the versions before it. A bucket keeps its ``KEPT`` newest
    versions."""

    def __init__(self, root: str, key: str, version_col: str, value_cols: list[str], buckets: int = 64):
        super().__init__(root, key, version_col, value_cols)
        self.buckets = buckets

    def read(self, spark, schema: str | None = None) -> DataFrame:
        """Every bucket at its newest finished version; raises if there is none."""
        return sinks.read_buckets(spark, self.root, schema)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        from hexvault.operators.marts import latest_by
        cols = [self.key, self.version_col, *self.value_cols]

        def latest(rows: DataFrame) -> DataFrame:
            stamped = rows.withColumn("_t", F.timestamp_micros(F.col(self.version_col).cast("long")))
            return latest_by(stamped, self.key, "_t", [], [*cols, "_b"])

        sinks.upsert_buckets(batch.sparkSession, self.root, batch.select(*cols), batch_id, self.key, self.buckets,
                             latest, self.KEPT)


class EmbeddingSink(BucketedFeatureSink):
    """Streaming item-embedding upsert keyed by ``vec_id`` (``updated_at`` orders versions); a
    batch rewrites the buckets of its items only."""

    def __init__(self, root: str, buckets: int = 64):
        super().__init__(root, "vec_id", "updated_at", ["embedding", "label"], buckets)

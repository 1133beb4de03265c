"""Registered streaming queries: the same results as the batch sinks, produced by a stream.

Each query serialises the delivered events as JSON message files under the shared
checkpoint folder, runs the vault stream with ``availableNow`` over several
micro-batches and returns the table the stream wrote.
Their oracles are the batch oracles: the stream must equal the batch.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from hexvault import oracle as O
from hexvault import schemas as S
from hexvault.operators import vault as V
from hexvault.operators.serving import ServingSource
from hexvault.plans.context import Context
from hexvault.plans import designed_queries  # noqa: F401  (registers the batch twins first)
from hexvault.plans.registry import ORACLES, register
from hexvault.session import checkpoint_path
from hexvault.sources import contracts as C
from hexvault.sources import files
from hexvault.streaming import ingest as I
from hexvault.streaming import sinks, state
from hexvault.streaming.features import BucketedFeatureSink

#: Micro-batches at most; each takes its share of the files that Spark wrote.
TRIGGERS = 4
#: Messages of a file: packed files are not split, so their number gives a batch its tasks.
FILE_MESSAGES = 25_000


def _run_stream(c: Context, topic: str, root: str | None = None) -> str:
    work = checkpoint_path(c.spark, "stream-queries", uuid.uuid4().hex)
    frame = c.clicks if topic == "events.clickstream" else c.pings
    src = f"{work}/messages"
    # Fast packing: as text the messages take 8 times the disk that the vault takes.
    (C.to_messages(frame, topic).write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
     .option("maxRecordsPerFile", FILE_MESSAGES).text(src))
    written = sum(n.startswith("part-") for n in files.children(c.spark, src))
    root = root or f"{work}/vault"
    q = I.start_vault_stream(c.spark, I.file_source(c.spark, src, -(-written // TRIGGERS)), topic, root,
                             checkpoint=f"{work}/checkpoint", available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return root


@register("stream_clickstream_log", ORACLES["clickstream_log"])
def _q(c: Context):
    """Realtime log written by the clickstream stream (availableNow, several micro-batches)."""
    return I.read_log(c.spark, _run_stream(c, "events.clickstream"))


@register("stream_live_couriers", ORACLES["live_courier_upsert"])
def _q(c: Context):
    """Keyed live table after upserting the telemetry micro-batches (latest per courier)."""
    root = _run_stream(c, "events.telemetry")
    return sinks.read_live(c.spark, root, S.COURIER_LIVE)


@register("vault_pinned_read", ORACLES["table_stats"])
def _q(c: Context):
    """Row counts of a vault read at pinned batches, after a later batch was written and committed."""
    root = _run_stream(c, I.CLICKS)
    _run_stream(c, I.PINGS, root)
    pinned = I.snapshot(c.spark, root)
    hub = I.read_vault(c.spark, root, pinned=pinned)["hub_user"]
    before = I.read_vault(c.spark, root, pinned=pinned)
    for name in [n for n in V.CLICK_SINKS if n in V.Vault.NAMES]:
        sinks.append_batch(hub if name == "hub_user" else before[name].limit(0), root, name, 10 ** 6)
    sinks.commit_batch(c.spark, root, I.CLICKS, 10 ** 6)  # readers without the pin now see it
    return ServingSource(I.read_vault(c.spark, root, pinned=pinned), c.models, "raw").stats()


def _finished(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def _work(c: Context) -> str:
    return checkpoint_path(c.spark, "stream-queries", uuid.uuid4().hex)


def _in_order(c: Context, work: str, slices: list, start):
    """Frames that arrive one after the other, a micro-batch each; returns the query of the last.

    A slice is as many files as it has tasks. ``start(source)`` starts the query on a
    checkpoint under ``work``, where it goes on after the slices it has seen.
    """
    query = None
    for rows in slices:
        rows.write.mode("append").parquet(f"{work}/events")
        query = start(c.spark.readStream.schema(slices[0].schema).parquet(f"{work}/events"))
        _finished(query)
    return query


#: Key of a row that only moves the watermark.
CLOCK = "~"
#: Delivered rows of a state bucket, over all slices; buckets for each state partition at least.
STATE_ROWS, PARTITION_BUCKETS = 500_000, 4


@register("stream_sat_history", ORACLES["d_sat_history"])
def _q(c: Context):
    """Historised courier status by a stateful stream, with replays and rows out of order by up to 30 days."""
    work = _work(c)
    first, last = c.vault["sat_courier_telemetry_spatial"].agg(F.min("load_date"), F.max("load_date")).first()
    width = (last - first).days / TRIGGERS + 1
    jitter = F.pmod(F.xxhash64("load_date", "latitude", "longitude"), F.lit(30))
    part = F.floor((F.datediff("load_date", F.lit(first)) + jitter) / F.lit(width))
    replayed = F.pmod(F.xxhash64("load_date", "longitude"), F.lit(10)) == 0
    # Rows beyond the last part come in a slice of their own; a replayed row comes in two.
    slices = F.when(part >= TRIGGERS, F.array(F.lit(TRIGGERS))).when(
        replayed & (part < TRIGGERS - 1), F.array(part, part + 1)).otherwise(F.array(part))
    rows = c.models["stg_courier_telemetry"].select("hk_courier_id", "load_date", *sinks.LIVE_TIE_BREAK)
    (rows.select("*", F.explode(slices).alias("_slice")).filter(F.col("_slice").isNotNull())
     .write.partitionBy("_slice").parquet(f"{work}/delivered"))  # staged once for all slices
    delivered = c.spark.read.parquet(f"{work}/delivered")
    frames = [delivered.filter(F.col("_slice") == k).drop("_slice") for k in range(TRIGGERS + 1)]
    frames.append(c.spark.range(1).select(
        F.lit(CLOCK).alias("hk_courier_id"), (F.lit(last) + F.expr("INTERVAL 400 DAYS")).alias("load_date"),
        *[F.lit(None).cast(rows.schema[t].dataType).alias(t) for t in sinks.LIVE_TIE_BREAK]))
    buckets = max(PARTITION_BUCKETS * int(c.spark.conf.get("spark.sql.shuffle.partitions")),
                  -(-delivered.count() // STATE_ROWS))
    schema = None

    def start(source):
        nonlocal schema
        out = state.history_stream(source, "hk_courier_id", "load_date", ["status"], sinks.LIVE_TIE_BREAK, "60 days",
                                   buckets)
        schema = out.schema
        return (out.writeStream.foreachBatch(lambda b, i: sinks.append_batch(b, work, "history", i) and None)
                .option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start())

    with state.OnState(c.spark):
        _in_order(c, work, frames, start)
    return sinks.read_appended(c.spark, work, "history", schema).select(
        "hk_courier_id", "load_date", "status", "hash_diff")


@register("stream_last5", ORACLES["d_last5"])
def _q(c: Context):
    """Last five clicked categories per user by a stateful stream over shuffled, replayed micro-batches."""
    work = _work(c)
    clicks = c.clicks_with_category.select("user_id", "event_type", "event_ts_ms", "event_id", "category")
    part = F.pmod(F.xxhash64("event_id"), F.lit(TRIGGERS))
    slices = [clicks.filter((part == k) | ((part == k - 1) & (F.col("event_ts_ms") % 7 == 0))) for k in range(TRIGGERS)]
    sink = BucketedFeatureSink(f"{work}/last5", "user_id", "version", ["last_categories"], buckets=16)

    def upsert(batch, batch_id: int) -> None:
        held = batch.persist()  # the sink reads its batch twice, the state may be stepped once only
        try:
            sink(held.withColumn("version", F.lit(batch_id + 1)), batch_id)
        finally:
            held.unpersist()

    with state.OnState(c.spark):
        _in_order(c, work, slices, lambda source: state.last_categories_stream(source).writeStream.outputMode("update")
                  .foreachBatch(upsert)
                  .option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start())
    return sink.read(c.spark).select("user_id", "last_categories")


_LATE_MS = 86_400_000


@register("stream_late_rows", O.with_chain(f"""
    SELECT 'window' AS kind, user_id, make_timestamp((event_ts_ms // 3600000) * 3600000000) AS window_start,
           count(*) AS n FROM click_once GROUP BY 2, 3
    UNION ALL
    SELECT 'late', NULL, NULL, count(*) FROM click_once
    WHERE event_ts_ms < (SELECT max(event_ts_ms) FROM click_once) - {_LATE_MS}"""))
def _q(c: Context):
    """Hourly counts per user, and the rows a listener saw dropped: old clicks sent again under new ids, late by a day."""
    clicks = c.clicks_once.select("event_id", "user_id", "event_ts_ms")
    last = clicks.agg(F.max("event_ts_ms")).first()[0]
    clock = lambda k, ms: c.spark.range(1).select(
        F.lit(f"{CLOCK}{k}").alias("event_id"), F.lit(CLOCK).alias("user_id"),
        F.lit(ms).cast(clicks.schema["event_ts_ms"].dataType).alias("event_ts_ms"))
    late = clicks.filter(F.col("event_ts_ms") < last - _LATE_MS).withColumn(
        "event_id", F.concat(F.lit("late-"), "event_id"))
    replays = clicks.filter(F.col("event_ts_ms") >= last - 60_000)  # in time, but known
    work, schema = _work(c), None
    listener = state.LateRows(c.spark, f"{work}/progress")

    def start(source):
        nonlocal schema
        windows = state.counted_windows(source, "user_id", "1 hour", "15 seconds", "5 minutes")
        schema = windows.schema
        return (windows.writeStream.foreachBatch(lambda b, i: sinks.append_batch(b, work, "windows", i) and None)
                .option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start())

    c.spark.streams.addListener(listener)
    try:
        listener.wait_for(_in_order(
            c, work, [clicks, clock(1, last + 1), late.unionByName(replays), clock(2, last + 2 * _LATE_MS)], start))
    finally:
        c.spark.streams.removeListener(listener)
    counts = sinks.read_appended(c.spark, work, "windows", schema).filter(F.col("user_id") != CLOCK)
    dropped = listener.read().agg(F.sum("late_rows").alias("n"))
    return counts.select(F.lit("window").alias("kind"), "user_id", F.col("window_start").cast("timestamp_ntz"),
                         F.col("events").alias("n")).unionByName(
        dropped.select(F.lit("late").alias("kind"), F.lit(None).cast("string").alias("user_id"),
                       F.lit(None).cast("timestamp_ntz").alias("window_start"), "n"))

"""Structured Streaming ingest: event streams → vault tables, live table and realtime log.

One streaming query per source. Each micro-batch is validated against its
contract (strict: a bad record fails the batch and so the query; ``quarantine``:
bad records go to a dead-letter table with their reasons), given its event time
(5-second watermark declared, as on the source; no stateful operator consumes it,
so late rows are never dropped), persisted once and fanned out to every sink of
that source. Sinks write one folder per batch id, so replaying a batch after a
restart rewrites the same files (exactly-once output on top of the checkpoint).

Sources: ``file_source`` reads newline-delimited JSON files (tests, backfills);
``kafka_source`` reads a topic from the earliest offset when the Kafka connector
is on the classpath (it is not in this build image).
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexvault import schemas as S
from hexvault.operators import vault as V
from hexvault.session import checkpoint_path
from hexvault.sources import contracts as C
from hexvault.streaming import sinks

WATERMARK_DELAY = "5 seconds"
SOURCE_TOPICS = ("events.clickstream", "events.telemetry")
DLQ_TABLE = "dead_letter"


class ContractViolation(RuntimeError):
    """Raised in strict mode when a micro-batch holds records that break the contract."""


def kafka_options(topic: str, bootstrap: str, event_format: str = "json") -> dict[str, str]:
    """Reader options: routed topic name, earliest offsets, fail on data loss."""
    return {"kafka.bootstrap.servers": bootstrap, "subscribe": C.topic_name(topic, event_format),
            "startingOffsets": "earliest", "failOnDataLoss": "true"}


def kafka_source(spark: SparkSession, topic: str, bootstrap: str) -> DataFrame:
    """``value`` as text from a Kafka topic (needs the spark-sql-kafka package)."""
    reader = spark.readStream.format("kafka")
    for k, v in kafka_options(topic, bootstrap).items():
        reader = reader.option(k, v)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def avro_source(spark: SparkSession, topic: str, bootstrap: str, avro_schema_json: str,
                schema_id: int) -> DataFrame:
    """Confluent-framed Avro topic as typed rows: check the 5-byte header, decode with ``from_avro``.

    ``schema_id`` is the id of ``avro_schema_json``; frames of another id fail the query.
    ``C.to_messages`` of the rows feeds ``start_vault_stream``.

    Needs the Kafka and Avro connector packages on the classpath (absent in this
    build image); the header split and contract → schema steps are tested alone.
    """
    from pyspark.sql.avro.functions import from_avro
    raw = spark.readStream.format("kafka")
    for k, v in kafka_options(topic, bootstrap, "avro").items():
        raw = raw.option(k, v)
    bodies = strict_bodies(raw.load().select(F.col("value").alias("frame")), schema_id)
    return bodies.select(from_avro(F.col("body"), avro_schema_json).alias("e")).select("e.*")


def strict_bodies(frames: DataFrame, schema_id: int) -> DataFrame:
    """``body`` of every framed message; a bad header or another schema id fails the read."""
    h = C.decode_frames(frames).select("header")
    known = F.col("header.valid") & (F.col("header.schema_id") == schema_id)
    return h.select(F.when(known, F.col("header.body")).otherwise(F.raise_error(F.concat(
        F.lit(f"frame without the header of schema {schema_id}: found "),
        F.coalesce(F.col("header.schema_id").cast("string"), F.lit("none"))))).alias("body"))


def file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Newline-delimited JSON messages from a folder, as a ``value`` text column."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def typed_stream(messages: DataFrame, topic: str) -> DataFrame:
    """Validated, typed stream: ``value, reasons, valid`` + contract columns + event time.

    Carries the source's 5-second event-time watermark. Invalid rows keep null
    typed columns; the sink routes them by ``valid``.
    """
    checked = C.validate_messages(messages, topic, parsed=True)
    typed = C.with_typed(checked, topic).select("value", "reasons", "valid", *[n for n, _, _ in C.contract(topic)])
    # the watermark needs an instant (TIMESTAMP); the vault keeps the UTC wall clock (NTZ)
    return (V.with_event_time(typed)
            .withColumn("event_time_ltz", F.timestamp_millis("event_ts_ms"))
            .withWatermark("event_time_ltz", WATERMARK_DELAY))


@dataclass
class VaultSink:
    """foreachBatch target writing all sinks of one source under ``root``."""

    root: str
    topic: str
    quarantine: bool = False
    written: list = field(default_factory=list)

    def tables(self) -> dict:
        return V.CLICK_SINKS if self.topic == "events.clickstream" else V.TELEMETRY_SINKS

    def held(self, batch: DataFrame) -> DataFrame:
        """What the sinks read of a batch: the message and its reasons of bad rows only, no derived times."""
        bad = ~F.col("valid")
        return batch.select(*[F.when(bad, F.col(c)).alias(c) for c in ("value", "reasons")], "valid",
                            *[n for n, _, _ in C.contract(self.topic)])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        """Route one micro-batch of ``typed_stream`` rows; the batch is computed once."""
        spark = batch.sparkSession
        batch = self.held(batch).persist()
        try:
            bad = batch.filter(~F.col("valid"))
            if bad.limit(1).count():
                if not self.quarantine:
                    sample = [r["reasons"] for r in bad.select("reasons").limit(3).collect()]
                    raise ContractViolation(f"{self.topic} batch {batch_id}: {sample}")
                sinks.append_batch(bad.select(F.lit(self.topic).alias("topic"), "value", "reasons",
                                              F.current_timestamp().alias("rejected_at")),
                                   self.root, DLQ_TABLE, batch_id)
            events = batch.filter("valid").drop("value", "reasons", "valid")
            for name, fn in self.tables().items():
                rows = fn(events)
                if name == "courier_telemetry_live":
                    sinks.upsert_live(spark, self.root, rows, batch_id, S.COURIER_LIVE)
                else:
                    sinks.append_batch(rows, self.root, name, batch_id)
            sinks.commit_batch(spark, self.root, self.topic, batch_id)
            self.written.append(batch_id)
        finally:
            batch.unpersist()


def start_vault_stream(spark: SparkSession, messages: DataFrame, topic: str, root: str,
                       checkpoint: str | None = None, available_now: bool = False,
                       processing_time: str | None = None, quarantine: bool = False):
    """Start the vault query for one source; returns the ``StreamingQuery``.

    The watermark is declared on the typed stream for parity with the source
    definition; the sink itself is stateless.
    """
    if topic not in SOURCE_TOPICS:
        raise ValueError(f"Unsupported source: {topic}")
    checkpoint = checkpoint or checkpoint_path(spark, "streams", topic.replace(".", "_"))
    writer = (typed_stream(messages, topic).writeStream.foreachBatch(VaultSink(root, topic, quarantine))
              .option("checkpointLocation", checkpoint).queryName(f"vault_{topic.replace('.', '_')}"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


CLICKS, PINGS = "events.clickstream", "events.telemetry"


def snapshot(spark: SparkSession, root: str, topics: tuple[str, ...] = (CLICKS, PINGS)) -> dict[str, list[str]]:
    """The committed batches of each topic: what a pinned read sees, whatever is written meanwhile."""
    return {t: sinks.committed_batches(spark, root, t) for t in topics}


def read_vault(spark: SparkSession, root: str, topics: tuple[str, ...] = (CLICKS, PINGS),
               pinned: dict[str, list[str]] | None = None) -> V.Vault:
    """The vault tables of the topics, all from one list of committed batches.

    Every table of a topic is read at the same batches, so a link and its satellite
    agree. A topic without any committed batch raises, and so does a table of a topic
    that was not asked for.
    """
    pinned = pinned or snapshot(spark, root, topics)

    def not_read():
        raise LookupError(f"only the tables of {topics} were asked for")

    tables = {n: not_read for n in V.Vault.NAMES}
    for topic in topics:
        names = V.CLICK_SINKS if topic == CLICKS else V.TELEMETRY_SINKS
        for n in V.Vault.NAMES:
            if n in names:
                tables[n] = sinks.read_batches(spark, root, n, S.VAULT_TABLES[n], pinned[topic])
    return V.Vault(tables)


def snapshot_id(pinned: dict[str, list[str]]) -> str:
    """Short name of a snapshot: its last batch per topic."""
    return ",".join(f"{t}@{b[-1]}" for t, b in sorted(pinned.items()))


def read_log(spark: SparkSession, root: str) -> DataFrame:
    return sinks.read_batches(spark, root, "clickstream_realtime_log", S.CLICKSTREAM_LOG,
                              sinks.committed_batches(spark, root, CLICKS))


def read_dead_letters(spark: SparkSession, root: str) -> DataFrame:
    """Rejected messages of all committed batches (none, if no batch had any)."""
    schema = "topic string, value string, reasons array<string>, rejected_at timestamp"
    return sinks.read_appended(spark, root, DLQ_TABLE, schema)


def bounded_read(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """Bounded read of a source (earliest → latest) as typed rows without computed columns.

    An invalid message fails the read with its reasons (``C.split_messages`` returns rejects instead).
    """
    checked = C.validate_messages(spark.read.text(path), topic)
    parsed = F.when(F.col("valid"), F.try_parse_json("value")).otherwise(F.raise_error(
        F.concat(F.lit(f"{topic}: "), F.concat_ws(",", "reasons"))))
    return checked.select(parsed.alias("_v")).select(*C.typed_columns(topic, "_v"))


def mart_refresh_stream(spark: SparkSession, vault_root: str, release_root: str,
                        interval: str = "300 seconds", checkpoint: str | None = None, on_error=None):
    """Rebuild and publish the marts whenever new vault files arrive (fixed-delay trigger).

    The trigger interval must be at least 30 seconds. A failed build leaves the
    last release active; the error is passed to ``on_error`` (by default it is logged
    with the number of failures in a row) and the query goes on.
    """
    from hexvault.plans import release as REL
    seconds = int(interval.split()[0])
    if seconds < 30:
        raise ValueError("Refresh interval must be at least 30 seconds")
    watch = f"{vault_root}/sat_interaction_context_spatial"
    probe = spark.readStream.schema(S.SAT_INTERACTION).parquet(watch).select(F.lit(1).alias("_"))

    failures = 0

    def refresh(_batch: DataFrame, batch_id: int) -> None:
        nonlocal failures
        try:
            pinned = snapshot(spark, vault_root)
            REL.publish(spark, read_vault(spark, vault_root, pinned=pinned), release_root, snapshot_id(pinned))
            failures = 0
        except Exception as exc:  # keep serving the last good release
            failures += 1
            if on_error:
                on_error(exc)
            else:
                logging.getLogger(__name__).error("refresh %s failed, %s in a row", batch_id, failures, exc_info=exc)

    checkpoint = checkpoint or checkpoint_path(spark, "streams", "mart_refresh")
    return (probe.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
            .trigger(processingTime=interval).start())

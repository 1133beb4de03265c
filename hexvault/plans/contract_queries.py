"""Registered contract queries: message validation (with DLQ reasons) and wire headers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexvault import oracle as O
from hexvault.operators.vault import with_event_time
from hexvault.schemas import COURIER_STATUSES, EVENT_TYPES
from hexvault.sources import contracts as C
from hexvault.sources.tables import clickstream_from_events, replayed_clickstream, telemetry_from_lineitem
from hexvault.plans.context import Context
from hexvault.plans.registry import register

DOMAINS = {"events.clickstream": {"event_type": EVENT_TYPES},
           "events.telemetry": {"status": COURIER_STATUSES}}
SOURCES = {"events.clickstream": "clickstream", "events.telemetry": "telemetry"}
_DUCK_ACCEPTS = {"string": ["VARCHAR"], "long": ["BIGINT", "UBIGINT"], "int": ["BIGINT", "UBIGINT"],
                 "double": ["BIGINT", "UBIGINT", "DOUBLE"]}


def _duck_reasons(topic: str) -> str:
    """DuckDB twin of ``validate_messages`` over ``msg`` (JSON text) → list of reasons."""
    arms = []
    names = []
    for name, typ, optional in C.contract(topic):
        names.append(f"'{name}'")
        jt = f"json_type(msg, '$.{name}')"
        if not optional:
            arms.append(f"CASE WHEN {jt} IS NULL THEN 'missing:{name}' END")
            arms.append(f"CASE WHEN {jt} = 'NULL' THEN 'null:{name}' END")
        ok = f"{jt} IN ({', '.join(repr(t) for t in _DUCK_ACCEPTS[typ])})"
        if typ == "int":
            ok += (f" AND TRY_CAST(json_extract(msg, '$.{name}') AS BIGINT) "
                   f"BETWEEN {C.INT32[0]} AND {C.INT32[1]}")
        arms.append(f"CASE WHEN {jt} IS NOT NULL AND {jt} <> 'NULL' AND NOT ({ok}) "
                    f"THEN 'wrong_type:{name}' END")
        allowed = DOMAINS[topic].get(name)
        if allowed:
            vals = ", ".join(f"'{v}'" for v in allowed)
            arms.append(f"CASE WHEN {jt} IS NOT NULL AND ({ok}) AND json_extract_string(msg, '$.{name}') "
                        f"NOT IN ({vals}) THEN 'invalid_value:{name}' END")
    unknown = (f"list_transform(list_filter(json_keys(msg), lambda k: NOT list_contains([{', '.join(names)}], k)), "
               f"lambda k: 'unknown:' || k)")
    return f"list_concat(list_filter([{', '.join(arms)}], lambda x: x IS NOT NULL), {unknown})"


def _duck_messages(topic: str) -> str:
    src = SOURCES[topic]
    pairs = ", ".join(f"'{n}', {n}" for n, _, _ in C.contract(topic))
    return f"SELECT CAST(json_object({pairs}) AS VARCHAR) AS msg FROM {src}"


def _violations_sql() -> str:
    parts = [f"SELECT '{t}' AS topic, unnest({_duck_reasons(t)}) AS reason FROM ({_duck_messages(t)})"
             for t in SOURCES]
    return O.with_chain(f"SELECT topic, reason, count(*) AS n_messages FROM ({' UNION ALL '.join(parts)}) "
                        f"GROUP BY topic, reason")


def _dealt(frame: DataFrame) -> DataFrame:
    """``frame`` in a task for each core: a table in few files may be few row groups, which are not cut for tasks."""
    spark = frame.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if len(frame.inputFiles()) >= cores:
        return frame
    return frame.repartition(max(cores, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _clicks(c: Context) -> DataFrame:
    return with_event_time(replayed_clickstream(clickstream_from_events(_dealt(c.table("events")))))


def _pings(c: Context) -> DataFrame:
    return with_event_time(telemetry_from_lineitem(_dealt(c.table("lineitem"))))


@register("contract_violations", _violations_sql())
def _q(c: Context):
    """Delivered events re-serialised as JSON messages and validated against their contracts.

    Result: rejection reasons with message counts (the dead-letter summary).
    """
    parts = []
    for topic, frame in (("events.clickstream", _clicks(c)), ("events.telemetry", _pings(c))):
        checked = C.validate_messages(C.to_messages(frame, topic), topic, domains=DOMAINS[topic])
        parts.append(checked.select(F.lit(topic).alias("topic"), F.explode("reasons").alias("reason")))
    return parts[0].unionByName(parts[1]).groupBy("topic", "reason").agg(
        F.count(F.lit(1)).alias("n_messages"))


#: Every seventh event is sent without its user, to be rejected.
_LOST = 7


@register("contract_rejects", O.with_chain(
    f"SELECT 'events.clickstream' AS topic, count(*) FILTER (CAST(event_id AS BIGINT) % {_LOST} <> 0) AS n_valid, "
    f"count(*) FILTER (CAST(event_id AS BIGINT) % {_LOST} = 0) AS n_rejected FROM clickstream"))
def _q(c: Context):
    """Messages of which some lost their user: typed valid rows and rejects are counted apart, none is lost."""
    topic = "events.clickstream"
    lost = F.when(F.col("event_id").cast("bigint") % _LOST != 0, F.col("user_id"))
    valid, rejects = C.split_messages(C.to_messages(_clicks(c).withColumn("user_id", lost), topic), topic)
    counted = valid.select(F.lit(1).alias("v"), F.lit(0).alias("r")).unionByName(
        rejects.select(F.lit(0).alias("v"), F.lit(1).alias("r")))
    return counted.agg(F.sum("v").alias("n_valid"), F.sum("r").alias("n_rejected")).select(
        F.lit(topic).alias("topic"), "n_valid", "n_rejected")


@register("wire_header", O.with_chain(
    """SELECT event_id, 0 AS magic, CAST(event_id % 5 AS BIGINT) AS schema_id,
              octet_length(encode(props)) AS body_bytes, event_id % 5 > 0 AS valid,
              CASE WHEN event_id % 5 > 0 THEN 'events.clickstream.avro.v1' ELSE 'events.clickstream' END AS topic
       FROM events"""))
def _q(c: Context):
    """Frame every event body with a schema id (event_id mod 5; 0 is invalid), then decode the headers."""
    ev = c.table("events")
    framed = ev.select("event_id", C.wire_frame(F.col("props"), F.col("event_id") % 5).alias("frame"))
    h = C.decode_frames(framed).select("event_id", "header.*")
    fmt = F.when(F.col("valid"), F.lit("avro")).otherwise(F.lit("json"))
    return h.select("event_id", "magic", "schema_id", F.length("body").cast("bigint").alias("body_bytes"), "valid",
                    C.route_topic(F.lit("events.clickstream"), fmt).alias("topic"))

"""Table access for the driver-generated parquet tables and the event surrogates.

The test tables carry no merchants, couriers or coordinates, so the clickstream and
telemetry event streams are derived from ``events`` and ``lineitem`` with pure
column expressions (narrow, no shuffle; every expression has a DuckDB twin in
``hexvault.oracle``). The derivation is the adapter a user would write to map a
public behaviour dataset onto the event contracts.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Surrogate domains and the constants of the coordinate rule.
EVENT_TYPE_MAP = [("view", "view_item"), ("click", "click"), ("signup", "add_to_cart"),
                  ("purchase", "purchase")]  # any other value (e.g. "error") passes through
DEVICE_TYPES = ["ios", "android", "web"]                              # by event_id % 3
REFERRER_PAGES = ["home_feed", "search", "nearby_deals", "recs_tray"]  # by user_id % 4
BASE_LAT = 10.745
BASE_LON = 106.66
COORD_STEP = 10000.0
COORD_MOD = 700
MERCHANT_MOD = 50
REPLAY_EVERY = 10  # every tenth event is delivered twice (at-least-once replay)
STATUS_BY_FLAGS = [("N", None, "idle"), ("R", None, "delivering"), ("A", "F", "to_merchant"),
                   ("A", "O", "at_merchant")]


def table_path(sf_dir: str, name: str) -> str:
    if name not in TABLES:
        raise ValueError(f"Unknown table: {name!r}")
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _pick(index: Column, values: list[str]) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(index == i, F.lit(v)) if expr is None else expr.when(index == i, F.lit(v))
    return expr


def padded_id(prefix: str, c: Column, width: int) -> Column:
    """Business key text: zero-padded up to ``width`` digits, longer numbers in full."""
    digits = c.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0")))


def id_number(c: str | Column, prefix: str) -> Column:
    """The number of a business key: all that follows its prefix."""
    c = F.col(c) if isinstance(c, str) else c
    return F.substr(c, F.lit(len(prefix) + 1)).cast("bigint")


def clickstream_from_events(events: DataFrame) -> DataFrame:
    """Map ``events`` onto the clickstream contract (one row per event, no shuffle)."""
    k = F.get_json_object(F.col("props"), "$.k").cast("bigint")
    etype = F.col("event_type")
    mapped = None
    for src, dst in EVENT_TYPE_MAP:
        mapped = (F.when(etype == src, F.lit(dst)) if mapped is None
                  else mapped.when(etype == src, F.lit(dst)))
    mapped = mapped.otherwise(etype)
    ts = F.col("ts").cast("timestamp")  # NTZ → session-tz (UTC) instant
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        padded_id("USR_", F.col("user_id"), 6).alias("user_id"),
        padded_id("ITM_", k, 5).alias("item_id"),
        padded_id("MCH_", k % MERCHANT_MOD, 4).alias("merchant_id"),
        mapped.alias("event_type"),
        _pick(F.col("event_id") % 3, DEVICE_TYPES).alias("device_type"),
        F.floor(F.col("value") * F.lit(100.0)).cast("bigint").alias("dwell_time_ms"),
        _pick(F.col("user_id") % 4, REFERRER_PAGES).alias("referrer_page"),
        (F.lit(BASE_LAT) + (F.col("event_id") % COORD_MOD) / F.lit(COORD_STEP)).alias("latitude"),
        (F.lit(BASE_LON) + ((F.col("user_id") * 37 + F.col("event_id") * 13) % COORD_MOD)
         / F.lit(COORD_STEP)).alias("longitude"),
        F.unix_millis(ts).alias("event_ts_ms"),
    )


def replayed_clickstream(clickstream: DataFrame) -> DataFrame:
    """At-least-once delivery: every tenth event arrives a second time (exact copy).

    One scan: each row is emitted once or twice with ``explode`` (same multiset as
    the union of the stream and its replays, without reading the input twice).
    """
    copies = F.when((F.col("event_id").cast("bigint") % REPLAY_EVERY) == 0, 2).otherwise(1)
    return (clickstream.select("*", F.explode(F.sequence(F.lit(1), copies)).alias("_copy"))
                       .drop("_copy"))


def telemetry_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Map ``lineitem`` onto the courier-telemetry contract (one ping per line)."""
    flag, status_flag = F.col("l_returnflag"), F.col("l_linestatus")
    status = None
    for rf, ls, value in STATUS_BY_FLAGS:
        cond = (flag == rf) if ls is None else ((flag == rf) & (status_flag == ls))
        status = F.when(cond, F.lit(value)) if status is None else status.when(cond, F.lit(value))
    ts = F.col("l_shipdate").cast("timestamp")
    return lineitem.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("telemetry_id"),
        padded_id("DRV_", F.col("l_suppkey"), 4).alias("courier_id"),
        F.when(F.col("l_linenumber") % 3 == 0, F.lit(None).cast("string"))
         .otherwise(padded_id("ORD_", F.col("l_orderkey"), 8)).alias("order_id"),
        (F.lit(BASE_LAT) + (F.col("l_partkey") % COORD_MOD) / F.lit(COORD_STEP)).alias("latitude"),
        (F.lit(BASE_LON) + (F.col("l_orderkey") % COORD_MOD) / F.lit(COORD_STEP)).alias("longitude"),
        F.col("l_quantity").cast("double").alias("speed_kmh"),
        (F.col("l_partkey") % 360).cast("int").alias("bearing_deg"),
        status.alias("status"),
        F.unix_millis(ts).alias("event_ts_ms"),
    )


def clickstream(spark: SparkSession, sf_dir: str, replay: bool = True) -> DataFrame:
    cs = clickstream_from_events(read_table(spark, sf_dir, "events"))
    return replayed_clickstream(cs) if replay else cs


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_from_lineitem(read_table(spark, sf_dir, "lineitem"))

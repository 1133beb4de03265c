"""Vault projections: events → hubs, link, satellites, live table and realtime log.

All eight are narrow projections of one source each (no shuffle). The same
functions serve the batch backfill and every streaming micro-batch.
``load_date`` carries the **event time** (UTC, time-zone-less, millisecond).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexvault.functions.hashing import composite_key, hash_key
from hexvault.functions.spatial import point_wkb, with_cells
from hexvault.schemas import RECORD_SOURCES

CLICK_SRC = RECORD_SOURCES["clickstream"]
TELEMETRY_SRC = RECORD_SOURCES["telemetry"]


def event_time(ms_col: str = "event_ts_ms") -> Column:
    """Event time from epoch milliseconds as a UTC wall-clock TIMESTAMP_NTZ."""
    return F.timestamp_millis(F.col(ms_col)).cast("timestamp_ntz")


def with_event_time(df: DataFrame) -> DataFrame:
    """Add ``proc_time`` and ``event_time`` computed columns of a source stream."""
    return df.withColumn("proc_time", F.current_timestamp()).withColumn("event_time", event_time())


def interaction_key() -> Column:
    """Link key: user; merchant; event_ts_ms (the item is not part of it)."""
    return composite_key("user_id", "merchant_id", F.col("event_ts_ms").cast("string"))


def _load_date(df: DataFrame) -> Column:
    return F.col("event_time") if "event_time" in df.columns else event_time()


def hub_user(clicks: DataFrame) -> DataFrame:
    return clicks.select(hash_key("user_id").alias("hk_user_id"), F.col("user_id"),
                         _load_date(clicks).alias("load_date"),
                         F.lit(CLICK_SRC).alias("record_source"))


def hub_merchant(clicks: DataFrame) -> DataFrame:
    return clicks.select(hash_key("merchant_id").alias("hk_merchant_id"), F.col("merchant_id"),
                         _load_date(clicks).alias("load_date"),
                         F.lit(CLICK_SRC).alias("record_source"))


def hub_courier(pings: DataFrame) -> DataFrame:
    return pings.select(hash_key("courier_id").alias("hk_courier_id"), F.col("courier_id"),
                        _load_date(pings).alias("load_date"),
                        F.lit(TELEMETRY_SRC).alias("record_source"))


def link_interaction(clicks: DataFrame) -> DataFrame:
    return clicks.select(interaction_key().alias("hk_interaction_id"),
                         hash_key("user_id").alias("hk_user_id"),
                         hash_key("merchant_id").alias("hk_merchant_id"),
                         _load_date(clicks).alias("load_date"),
                         F.lit(CLICK_SRC).alias("record_source"))


def _cells(df: DataFrame) -> DataFrame:
    return with_cells(df, "latitude", "longitude", {7: "h3_res7", 9: "h3_res9"})


def sat_interaction(clicks: DataFrame, with_wkb: bool = True) -> DataFrame:
    wkb = (point_wkb("latitude", "longitude") if with_wkb
           else F.lit(None).cast("binary"))
    return _cells(clicks).select(
        interaction_key().alias("hk_interaction_id"), _load_date(clicks).alias("load_date"),
        "event_type", "device_type", "dwell_time_ms", "referrer_page", "latitude", "longitude",
        "h3_res7", "h3_res9", wkb.alias("geom_wkb"), F.lit(CLICK_SRC).alias("record_source"))


def sat_courier(pings: DataFrame, with_wkb: bool = True) -> DataFrame:
    wkb = (point_wkb("latitude", "longitude") if with_wkb
           else F.lit(None).cast("binary"))
    return _cells(pings).select(
        hash_key("courier_id").alias("hk_courier_id"), _load_date(pings).alias("load_date"),
        "latitude", "longitude", "speed_kmh", "bearing_deg", "status", "h3_res7", "h3_res9",
        wkb.alias("geom_wkb"), F.lit(TELEMETRY_SRC).alias("record_source"))


def courier_live_rows(pings: DataFrame) -> DataFrame:
    """Rows for the keyed live table (before the latest-per-key upsert)."""
    return _cells(pings).select(
        hash_key("courier_id").alias("hk_courier_id"), "courier_id", "latitude", "longitude",
        "speed_kmh", "bearing_deg", "status", "h3_res7", "h3_res9", "event_ts_ms")


def clickstream_log(clicks: DataFrame) -> DataFrame:
    return _cells(clicks).select(
        interaction_key().alias("hk_interaction_id"), "user_id", "merchant_id", "event_type",
        "device_type", "dwell_time_ms", "latitude", "longitude", "h3_res7", "h3_res9",
        "event_ts_ms")


CLICK_SINKS = {
    "hub_user": hub_user,
    "hub_merchant": hub_merchant,
    "link_user_merchant_interaction": link_interaction,
    "sat_interaction_context_spatial": sat_interaction,
    "clickstream_realtime_log": clickstream_log,
}
TELEMETRY_SINKS = {
    "hub_courier": hub_courier,
    "sat_courier_telemetry_spatial": sat_courier,
    "courier_telemetry_live": courier_live_rows,
}


class Vault:
    """The six raw vault tables as lazy DataFrames, built from two event streams.

    ``from_events`` derives them from already-loaded event DataFrames (backfill);
    ``from_tables`` wraps stored tables (e.g. a versioned parquet snapshot).
    """

    NAMES = ("hub_user", "hub_merchant", "hub_courier", "link_user_merchant_interaction",
             "sat_interaction_context_spatial", "sat_courier_telemetry_spatial")

    def __init__(self, tables: dict):
        """``tables`` maps each name to a DataFrame or a zero-argument builder."""
        missing = [n for n in self.NAMES if n not in tables]
        if missing:
            raise ValueError(f"Vault tables missing: {missing}")
        self.tables = dict(tables)

    def __getitem__(self, name: str) -> DataFrame:
        value = self.tables[name]
        if callable(value):  # built on first use
            value = self.tables[name] = value()
        return value

    @classmethod
    def from_events(cls, clicks, pings, with_wkb: bool = True) -> "Vault":
        """Vault over two event frames (each a DataFrame or a zero-argument builder)."""
        c = clicks if callable(clicks) else (lambda: clicks)
        p = pings if callable(pings) else (lambda: pings)
        return cls({
            "hub_user": lambda: hub_user(c()),
            "hub_merchant": lambda: hub_merchant(c()),
            "hub_courier": lambda: hub_courier(p()),
            "link_user_merchant_interaction": lambda: link_interaction(c()),
            "sat_interaction_context_spatial": lambda: sat_interaction(c(), with_wkb),
            "sat_courier_telemetry_spatial": lambda: sat_courier(p(), with_wkb),
        })

    @classmethod
    def from_tables(cls, spark, root: str) -> "Vault":
        import os
        return cls({n: spark.read.parquet(os.path.join(root, n)) for n in cls.NAMES})

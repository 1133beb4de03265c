"""Designed vault entities: item hub and user–item link, order hub, delivery trips,
the user–interaction–merchant bridge and current-satellite views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexvault.functions.hashing import composite_key, hash_key, hash_key_std
from hexvault.operators.marts import latest_by
from hexvault.sources.tables import padded_id


def hub_item(clicks: DataFrame) -> DataFrame:
    """Item hub: hash of the item id, first time seen (grouped by hash and id)."""
    return clicks.groupBy(hash_key("item_id").alias("hk_item_id"), "item_id").agg(
        F.min("event_time").alias("first_seen_at"))


def link_user_item(clicks: DataFrame) -> DataFrame:
    """User–item interaction link with the documented standard key (event time, item, user)."""
    return clicks.groupBy(hash_key_std(["event_ts_ms", "item_id", "user_id"]).alias("hk_interaction_id"),
                          hash_key("user_id").alias("hk_user_id"), hash_key("item_id").alias("hk_item_id")).agg(
        F.min("event_time").alias("first_seen_at"))


def hub_order(orders: DataFrame) -> DataFrame:
    """Order hub keyed by the order business key text (``ORD_`` + at least 8 digits)."""
    oid = padded_id("ORD_", F.col("o_orderkey"), 8)
    return orders.select(hash_key(oid).alias("hk_order_id"), oid.alias("order_id"),
                         F.col("o_orderdate").cast("timestamp_ntz").alias("load_date"))


def delivery_trips(pings: DataFrame) -> DataFrame:
    """Order ↔ courier delivery link with first/last ping and ping count per trip."""
    p = pings.filter(F.col("order_id").isNotNull())
    return p.groupBy(composite_key("order_id", "courier_id").alias("hk_trip_id"),
                     hash_key("order_id").alias("hk_order_id"), hash_key("courier_id").alias("hk_courier_id")).agg(
        F.min("event_time").alias("first_ping"), F.max("event_time").alias("last_ping"),
        F.count(F.lit(1)).alias("pings"))


def bridge_user_merchant(links: DataFrame, sat: DataFrame) -> DataFrame:
    """Precomputed hub–link path: user → interaction → merchant with the event time."""
    s = sat.select("hk_interaction_id", F.col("load_date").alias("event_at")).distinct()
    return links.select("hk_user_id", "hk_interaction_id", "hk_merchant_id").distinct() \
                .join(s, "hk_interaction_id")


def current_view(sat: DataFrame, key: str, ts: str, tie_break: list[str]) -> DataFrame:
    """Current row per key of a historised satellite (latest ``ts``, ties ascending)."""
    return latest_by(sat, key, ts, tie_break, sat.columns)


def sat_merchant_location(fact: DataFrame) -> DataFrame:
    """Daily merchant location satellite: mean interaction point and its res-7 cell per day."""
    from hexvault.functions.numeric import exact_mean
    from hexvault.functions.spatial import with_cells
    daily = fact.groupBy(hash_key("merchant_id").alias("hk_merchant_id"),
                         F.to_date("event_at").alias("load_day")).agg(
        exact_mean("latitude").alias("latitude"), exact_mean("longitude").alias("longitude"),
        F.count(F.lit(1)).alias("interactions"))
    return with_cells(daily, "latitude", "longitude", {7: "h3_res7"})


def dim_merchants(stg_merchants: DataFrame, fact: DataFrame) -> DataFrame:
    """Merchant dimension: id, first seen, interactions, purchases, last interaction."""
    f = fact.groupBy("hk_merchant_id").agg(
        F.count(F.lit(1)).alias("interactions"),
        F.sum((F.col("event_type") == "purchase").cast("long")).alias("purchases"),
        F.max("event_at").alias("last_interaction_at"))
    return stg_merchants.join(f, "hk_merchant_id", "left").select(
        "hk_merchant_id", "merchant_id", "first_seen_at", F.coalesce("interactions", F.lit(0)).alias("interactions"),
        F.coalesce("purchases", F.lit(0)).alias("purchases"), "last_interaction_at")


def dim_couriers(stg_couriers: DataFrame, telemetry: DataFrame, positions: DataFrame) -> DataFrame:
    """Courier dimension: id, first seen, pings, current status and cell."""
    p = telemetry.groupBy("hk_courier_id").agg(F.count(F.lit(1)).alias("pings"))
    cur = positions.select("hk_courier_id", F.col("status").alias("current_status"),
                           F.col("h3_res7").alias("current_h3_res7"))
    return (stg_couriers.join(p, "hk_courier_id", "left").join(cur, "hk_courier_id", "left")
            .select("hk_courier_id", "courier_id", "first_seen_at", F.coalesce("pings", F.lit(0)).alias("pings"),
                    "current_status", "current_h3_res7"))

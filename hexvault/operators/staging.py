"""Staging models: replay-tolerant views of the append-only vault.

Exact replays collapse; conflicting payloads keep their duplicate keys so the
quality checks can find them. Hubs and links group by hash **and** business key
(never ``dropDuplicates([hash])``), so a hash that maps to two ids stays visible.
All are hash aggregates with map-side partial aggregation, so a hot key (one user
with a third of all rows) is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INTERACTION_COLUMNS = ["hk_interaction_id", "load_date", "event_type", "device_type",
                       "dwell_time_ms", "referrer_page", "latitude", "longitude",
                       "h3_res7", "h3_res9"]
TELEMETRY_COLUMNS = ["hk_courier_id", "load_date", "latitude", "longitude", "speed_kmh",
                     "bearing_deg", "status", "h3_res7", "h3_res9"]


def first_seen(hub: DataFrame, keys: list[str]) -> DataFrame:
    """``min(load_date)`` per key set, as ``first_seen_at``."""
    return hub.groupBy(*keys).agg(F.min("load_date").alias("first_seen_at"))


def stg_users(hub_user: DataFrame) -> DataFrame:
    return first_seen(hub_user, ["hk_user_id", "user_id"])


def stg_merchants(hub_merchant: DataFrame) -> DataFrame:
    return first_seen(hub_merchant, ["hk_merchant_id", "merchant_id"])


def stg_couriers(hub_courier: DataFrame) -> DataFrame:
    return first_seen(hub_courier, ["hk_courier_id", "courier_id"])


def stg_interaction_links(link: DataFrame) -> DataFrame:
    return first_seen(link, ["hk_interaction_id", "hk_user_id", "hk_merchant_id"])


def stg_interactions(sat: DataFrame) -> DataFrame:
    """Whole-row DISTINCT after leaving out ``geom_wkb`` and ``record_source``."""
    return sat.select(*INTERACTION_COLUMNS).distinct()


def stg_courier_telemetry(sat: DataFrame) -> DataFrame:
    """Whole-row DISTINCT; the chunk of rows that are ``dealt`` stays, so equal rows lie together already."""
    return sat.select(*TELEMETRY_COLUMNS, *[c for c in sat.columns if c == "_chunk"]).distinct()

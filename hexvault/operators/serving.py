"""Serving queries over either the raw vault or a published set of marts.

``ServingSource`` resolves logical tables to DataFrames and returns lazy query
plans; the caller decides how many rows to fetch. Request parameters are
validated here and always enter the plan as literals (never as SQL text).
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hexvault.functions.numeric import exact_mean, exact_weighted_mean
from hexvault.functions.spatial import (haversine_m, hex_lower, neighbour_cells_py,
                                        round_half_up)
from hexvault.operators import marts as M
from hexvault.operators.vault import Vault
from hexvault.plans.models import Models

IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]{0,63}")

# Request limits (min, max, default) and response defaults.
LIMITS = {"recommendations": (1, 50, 10), "hexagons": (1, 500, 100), "couriers": (1, 200, 50)}
DEFAULT_DISTANCE_M = 1000.0
SCORE_DISTANCE_SCALE_M = 2000.0
ENTITIES = ("interactions", "couriers")

# Logical table → staging model (mart mode) / raw vault table (raw mode).
STATS_TABLES = {
    "hub_user": "stg_users", "hub_merchant": "stg_merchants", "hub_courier": "stg_couriers",
    "link_user_merchant_interaction": "stg_interaction_links",
    "sat_interaction_context_spatial": "stg_interactions",
    "sat_courier_telemetry_spatial": "stg_courier_telemetry",
}


def identifier(name: str) -> str:
    if not isinstance(name, str) or not IDENTIFIER.fullmatch(name):
        raise ValueError(f"Invalid identifier: {name!r}")
    return name


def check_limit(kind: str, limit: int) -> int:
    lo, hi, _ = LIMITS[kind]
    if type(limit) is not int or not lo <= limit <= hi:
        raise ValueError(f"{kind} limit must be an integer in [{lo}, {hi}]")
    return limit


def check_point(lat: float, lon: float) -> None:
    if not isinstance(lat, (int, float)) or not -90.0 <= float(lat) <= 90.0:
        raise ValueError("lat must be within [-90, 90]")
    if not isinstance(lon, (int, float)) or not -180.0 <= float(lon) <= 180.0:
        raise ValueError("lon must be within [-180, 180]")


class ServingSource:
    """Logical serving tables over the raw vault (``mode='raw'``) or marts (``'mart'``)."""

    def __init__(self, vault: Vault, models: Models | None = None, mode: str = "raw"):
        if mode not in ("raw", "mart"):
            raise ValueError("mode must be 'raw' or 'mart'")
        if mode == "mart" and models is None:
            raise ValueError("No marts configured")
        self.vault, self.models, self.mode = vault, models, mode

    # -- logical inputs --------------------------------------------------------------
    def interactions(self) -> DataFrame:
        """Interaction facts with ``merchant_id``.

        Raw mode de-duplicates each side **before** joining so replayed hubs and
        links do not multiply satellite rows (and there is no user hub join).
        """
        if self.mode == "mart":
            f = self.models["fct_interactions"]
            return f.withColumnRenamed("event_at", "load_date")
        sat = self.vault["sat_interaction_context_spatial"].select(
            "hk_interaction_id", "load_date", "latitude", "longitude", "h3_res7", "h3_res9",
            "dwell_time_ms", "event_type", "device_type", "referrer_page").distinct()
        link = self.vault["link_user_merchant_interaction"].select(
            "hk_interaction_id", "hk_merchant_id").distinct()
        hub = self.vault["hub_merchant"].select("hk_merchant_id", "merchant_id").distinct()
        return sat.join(link, "hk_interaction_id").join(hub, "hk_merchant_id").drop("hk_merchant_id")

    def couriers(self) -> DataFrame:
        """Current courier positions (latest per courier, total order)."""
        if self.mode == "mart":
            return self.models["current_courier_positions"]
        latest = M.latest_positions(self.vault["sat_courier_telemetry_spatial"])
        hub = self.vault["hub_courier"].select("hk_courier_id", "courier_id").distinct()
        return latest.join(hub, "hk_courier_id").select(*M.POSITION_COLUMNS)

    def table(self, logical: str) -> DataFrame:
        identifier(logical)
        if logical not in STATS_TABLES:
            raise ValueError(f"Unknown logical table: {logical}")
        return self.models[STATS_TABLES[logical]] if self.mode == "mart" else self.vault[logical]

    def readiness(self) -> DataFrame:
        """Schema-only probe: one row per table with its column count (no data read)."""
        names = list(STATS_TABLES)
        extra = (["fct_interactions", "current_courier_positions", "mart_h3_demand_hourly"]
                 if self.mode == "mart" else [])
        spark = self.vault["hub_user"].sparkSession
        rows = []
        for n in names:
            rows.append((n, len(self.table(n).limit(0).schema.fields)))
        for n in extra:
            rows.append((n, len(self.models[n].limit(0).schema.fields)))
        return spark.createDataFrame(rows, "table_name string, column_count int")

    # -- queries ---------------------------------------------------------------------
    def merchant_candidates(self, lat: float, lon: float, neighbors=()) -> DataFrame:
        """Per-merchant popularity and distance of its mean interaction point."""
        df = self.interactions().filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        if neighbors:
            df = df.filter(F.col("h3_res7").isin([int(c) for c in neighbors]))
        agg = df.groupBy("merchant_id").agg(
            F.count(F.lit(1)).alias("interaction_count"),
            exact_mean("latitude").alias("_lat"), exact_mean("longitude").alias("_lon"),
            F.max("h3_res7").alias("_cell"))
        dist = round_half_up(haversine_m(F.col("_lat"), F.col("_lon"), F.lit(float(lat)),
                                         F.lit(float(lon))), 1)
        return agg.select(
            "merchant_id", "interaction_count",
            round_half_up("_lat", 6).alias("avg_lat"), round_half_up("_lon", 6).alias("avg_lon"),
            hex_lower("_cell").alias("sample_h3_res7"), dist.alias("dist_meters"))

    def recommendations(self, lat: float, lon: float, limit: int = 10, neighbors=()) -> DataFrame:
        """Top-k merchants by ``round(n / (1 + coalesce(dist, 1000)/2000), 2)``."""
        check_point(lat, lon)
        check_limit("recommendations", limit)
        cand = self.merchant_candidates(lat, lon, neighbors)
        score = round_half_up(
            F.col("interaction_count")
            / (F.lit(1.0) + F.coalesce(F.col("dist_meters"), F.lit(DEFAULT_DISTANCE_M))
               / F.lit(SCORE_DISTANCE_SCALE_M)), 2)
        return (cand.withColumn("score", score)
                    .orderBy(F.col("score").desc(), F.col("interaction_count").desc(),
                             F.col("merchant_id").asc())
                    .limit(limit))

    def recommend_near_with_fallback(self, lat: float, lon: float, limit: int = 10) -> DataFrame:
        """Neighbour-restricted ranking (user cell + 6 neighbours); global ranking only if empty.

        The near ranking runs first, its cell filter in the scan; its at most ``limit`` rows
        are the answer. Only if there are none the global ranking is planned.
        """
        check_point(lat, lon)
        check_limit("recommendations", limit)
        cells = [int(c) for c in neighbour_cells_py(float(lat), float(lon), 7)]
        chosen = self.recommendations(lat, lon, limit, cells)
        rows = chosen.collect()  # at most `limit`
        if rows:
            chosen = chosen.sparkSession.createDataFrame(rows, chosen.schema)
        else:
            chosen = self.recommendations(lat, lon, limit)
        order = Window.partitionBy().orderBy(F.col("score").desc(), F.col("interaction_count").desc(),
                                             F.col("merchant_id").asc())  # at most `limit` rows
        return (chosen.withColumn("rank", F.row_number().over(order))
                      .withColumn("dist_meters", F.coalesce("dist_meters", F.lit(DEFAULT_DISTANCE_M))))

    def hexagons(self, entity: str, resolution: int, limit: int = 100) -> DataFrame:
        """Top cells by count for interactions or current couriers."""
        if resolution not in (7, 9) or entity not in ENTITIES:
            raise ValueError("Unsupported spatial query")
        check_limit("hexagons", limit)
        column = f"h3_res{resolution}"
        order = [F.col("metric_count").desc(), F.col("h3_hex").asc()]
        if entity == "couriers":
            pos = self.couriers().filter(F.col(column).isNotNull())
            out = pos.groupBy(column).agg(
                F.count(F.lit(1)).alias("metric_count"), exact_mean("latitude").alias("centroid_lat"),
                exact_mean("longitude").alias("centroid_lon"), exact_mean("speed_kmh").alias("avg_speed_kmh"),
                F.count(F.lit(1)).alias("active_couriers"))
            return out.select(hex_lower(column).alias("h3_hex"), "metric_count", "centroid_lat",
                              "centroid_lon", "avg_speed_kmh", "active_couriers"
                              ).orderBy(*order).limit(limit)
        if self.mode == "mart":
            mart = self.models["mart_h3_demand_hourly"].filter(F.col("resolution") == resolution)
            n = F.col("event_count")
            out = mart.groupBy("h3_cell").agg(
                F.sum(n).alias("metric_count"),
                exact_weighted_mean("centroid_latitude", n).alias("centroid_lat"),
                exact_weighted_mean("centroid_longitude", n).alias("centroid_lon"),
                (F.sum("total_dwell_time_ms") / F.nullif(F.sum("dwell_sample_count"), F.lit(0)))
                .alias("avg_dwell_ms"))
            return out.select(hex_lower("h3_cell").alias("h3_hex"), "metric_count", "centroid_lat",
                              "centroid_lon", "avg_dwell_ms").orderBy(*order).limit(limit)
        sat = self.vault["sat_interaction_context_spatial"].select(
            "hk_interaction_id", "load_date", "latitude", "longitude", "h3_res7", "h3_res9",
            "dwell_time_ms", "event_type", "device_type", "referrer_page").distinct()
        out = sat.filter(F.col(column).isNotNull()).groupBy(column).agg(
            F.count(F.lit(1)).alias("metric_count"), exact_mean("latitude").alias("centroid_lat"),
            exact_mean("longitude").alias("centroid_lon"), exact_mean("dwell_time_ms").alias("avg_dwell_ms"))
        return out.select(hex_lower(column).alias("h3_hex"), "metric_count", "centroid_lat",
                          "centroid_lon", "avg_dwell_ms").orderBy(*order).limit(limit)

    def live_couriers(self, status: str | None = None, limit: int = 50) -> DataFrame:
        """Current couriers, newest first; the status filter applies **after** latest-row selection."""
        check_limit("couriers", limit)
        pos = self.couriers().filter(F.col("h3_res7").isNotNull())
        if status is not None:
            pos = pos.filter(F.col("status") == F.lit(status))
        return (pos.select("courier_id", "latitude", "longitude", "speed_kmh", "bearing_deg",
                           "status", hex_lower("h3_res7").alias("h3_res7"),
                           hex_lower("h3_res9").alias("h3_res9"), "load_date")
                   .orderBy(F.col("load_date").desc(), F.col("courier_id").asc())
                   .limit(limit))

    def stats(self) -> DataFrame:
        """Row count per logical table (one aggregate per table, UNION ALL)."""
        parts = [self.table(n).agg(F.count(F.lit(1)).alias("row_count"))
                 .select(F.lit(n).alias("table_name"), "row_count") for n in STATS_TABLES]
        return reduce(DataFrame.unionByName, parts)


def hexagon_features(hexagons: DataFrame, metric: str = "avg_dwell_ms") -> DataFrame:
    """Response shape: hex, count, centroid [lon, lat], properties; null hex rows skipped."""
    return (hexagons.filter(F.col("h3_hex").isNotNull())
            .select("h3_hex", F.col("metric_count").alias("count"),
                    F.array("centroid_lon", "centroid_lat").alias("centroid"),
                    F.struct(F.coalesce(F.col(metric), F.lit(0)).alias(metric)).alias("properties")))


def courier_response(couriers: DataFrame) -> DataFrame:
    """Null speed / bearing become 0 in responses."""
    return (couriers.withColumn("speed_kmh", F.coalesce("speed_kmh", F.lit(0.0)))
                    .withColumn("bearing_deg", F.coalesce("bearing_deg", F.lit(0))))

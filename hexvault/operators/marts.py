"""Business-vault and mart models: latest positions, interaction fact, demand marts.

Latest-row selection uses a ``min(struct(order key…, payload…))`` aggregate rather
than a ``row_number`` window: it has the same total order as the window
(load_date desc nulls last, then status, latitude, longitude, speed_kmh,
bearing_deg, h3_res7, h3_res9 asc nulls first) but combines map-side, so one
courier with a third of all pings never lands whole in a single sort task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexvault.functions.numeric import exact_mean

POSITION_TIE_BREAK = ["status", "latitude", "longitude", "speed_kmh", "bearing_deg",
                      "h3_res7", "h3_res9"]
POSITION_COLUMNS = ["hk_courier_id", "courier_id", "load_date", "latitude", "longitude",
                    "speed_kmh", "bearing_deg", "status", "h3_res7", "h3_res9"]
FACT_COLUMNS = ["hk_interaction_id", "hk_user_id", "hk_merchant_id", "user_id", "merchant_id",
                "event_at", "event_type", "device_type", "dwell_time_ms", "referrer_page",
                "latitude", "longitude", "h3_res7", "h3_res9"]


def latest_by(df: DataFrame, key: str, time_col: str, tie_break: list[str],
              payload: list[str]) -> DataFrame:
    """One row per ``key``: latest ``time_col``, ties broken by ``tie_break`` ascending.

    Implemented as a partial-aggregatable ``min`` over a struct whose leading
    fields encode the order; the remaining fields carry the payload.
    """
    t = F.col(time_col)
    order: list[Column] = [t.isNull().alias("_k_null"),
                           (-F.unix_micros(t.cast("timestamp"))).alias("_k_time")]
    order += [F.col(c).alias(f"_k_{i}") for i, c in enumerate(tie_break)]
    fields = order + [F.col(c).alias(c) for c in payload if c != key]
    best = df.groupBy(key).agg(F.min(F.struct(*fields)).alias("_best"))
    return best.select(key, *[F.col(f"_best.{c}").alias(c) for c in payload if c != key])


def latest_positions(telemetry: DataFrame) -> DataFrame:
    """Latest ping per courier from de-duplicated telemetry (total order, W02)."""
    cols = ["hk_courier_id", "load_date", "latitude", "longitude", "speed_kmh", "bearing_deg",
            "status", "h3_res7", "h3_res9"]
    return latest_by(telemetry, "hk_courier_id", "load_date", POSITION_TIE_BREAK, cols)


def current_courier_positions(telemetry: DataFrame, stg_couriers: DataFrame) -> DataFrame:
    """Latest position joined to the courier hub (conflicting ids multiply, and tests catch it).

    ``telemetry`` may be the staged (distinct) telemetry or the raw satellite: the
    latest row under a total order is the same with or without exact replays.
    """
    latest = latest_positions(telemetry)
    couriers = stg_couriers.select("hk_courier_id", "courier_id")
    return latest.join(couriers, "hk_courier_id", "inner").select(*POSITION_COLUMNS)


def fct_interactions(stg_interactions: DataFrame, stg_links: DataFrame, stg_users: DataFrame,
                     stg_merchants: DataFrame) -> DataFrame:
    """Interaction fact: satellite ⋈ link ⋈ user hub ⋈ merchant hub (inner).

    The first join is fact-to-fact (sort-merge on the interaction hash); the hub
    joins are broadcast by the planner only when their measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks it at runtime), and
    AQE splits skewed user/merchant partitions otherwise.
    """
    s = stg_interactions.alias("s")
    l = stg_links.select("hk_interaction_id", "hk_user_id", "hk_merchant_id").alias("l")
    u = stg_users.select("hk_user_id", "user_id").alias("u")
    m = stg_merchants.select("hk_merchant_id", "merchant_id").alias("m")
    return (s.join(l, F.col("s.hk_interaction_id") == F.col("l.hk_interaction_id"))
             .join(u, F.col("l.hk_user_id") == F.col("u.hk_user_id"))
             .join(m, F.col("l.hk_merchant_id") == F.col("m.hk_merchant_id"))
             .select(F.col("s.hk_interaction_id"), F.col("l.hk_user_id"), F.col("l.hk_merchant_id"),
                     F.col("u.user_id"), F.col("m.merchant_id"), F.col("s.load_date").alias("event_at"),
                     F.col("s.event_type"), F.col("s.device_type"), F.col("s.dwell_time_ms"),
                     F.col("s.referrer_page"), F.col("s.latitude"), F.col("s.longitude"),
                     F.col("s.h3_res7"), F.col("s.h3_res9")))


def cells_both_resolutions(fact: DataFrame, extra: list[str]) -> DataFrame:
    """One scan, two rows per fact (res 7 and 9): ``explode(array(struct, struct))``.

    Rows whose cell is null are dropped per resolution (same as two filtered scans
    joined by UNION ALL).
    """
    pairs = F.array(F.struct(F.lit(7).alias("resolution"), F.col("h3_res7").alias("h3_cell")),
                    F.struct(F.lit(9).alias("resolution"), F.col("h3_res9").alias("h3_cell")))
    return (fact.select(*extra, F.explode(pairs).alias("_c"))
                .select(F.col("_c.h3_cell").alias("h3_cell"), F.col("_c.resolution").alias("resolution"),
                        *extra)
                .filter(F.col("h3_cell").isNotNull()))


def mart_h3_demand_hourly(fact: DataFrame) -> DataFrame:
    """Hourly demand per cell × resolution × hour × event type, with mergeable partials."""
    cells = cells_both_resolutions(
        fact.withColumn("event_hour", F.date_trunc("hour", F.col("event_at")).cast("timestamp_ntz")),
        ["event_hour", "event_type", "dwell_time_ms", "latitude", "longitude"])
    return (cells.groupBy("h3_cell", "resolution", "event_hour", "event_type")
                 .agg(F.count(F.lit(1)).alias("event_count"),
                      F.sum("dwell_time_ms").alias("total_dwell_time_ms"),
                      F.count("dwell_time_ms").alias("dwell_sample_count"),
                      exact_mean("latitude").alias("centroid_latitude"),
                      exact_mean("longitude").alias("centroid_longitude")))


def mart_user_merchant_affinity(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("hk_user_id", "hk_merchant_id")
                .agg(F.count(F.lit(1)).alias("interaction_count"),
                     F.sum(F.when(F.col("event_type") == "purchase", 1).otherwise(0))
                      .cast("bigint").alias("purchase_count"),
                     F.max("event_at").alias("last_interaction_at")))

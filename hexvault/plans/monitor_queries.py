"""Registered monitoring, watermark, release-history and cell-bit queries."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from hexvault import oracle as O
from hexvault.functions import spatial as SP
from hexvault.operators import monitor as MON
from hexvault.plans import release as REL
from hexvault.plans.context import Context, round_doubles
from hexvault.plans.registry import register
from hexvault.session import checkpoint_path

_COUNTS = """counts AS (
    SELECT 'interactions' AS stream, CAST(load_date AS DATE) AS event_day, count(*) AS event_count
    FROM (SELECT DISTINCT hk_interaction_id, load_date FROM sat_i_v) GROUP BY 2
    UNION ALL
    SELECT 'couriers', CAST(load_date AS DATE), count(*)
    FROM (SELECT DISTINCT hk_courier_id, load_date FROM sat_c_v) GROUP BY 2)"""

_ASSESS = """bounds AS (SELECT stream, min(event_day) AS lo, max(event_day) AS hi FROM counts GROUP BY stream),
spine AS (SELECT stream, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS target_day FROM bounds),
series AS (SELECT s.stream, s.target_day, c.event_count, (s.target_day - DATE '1970-01-01') AS d
           FROM spine s LEFT JOIN counts c ON s.stream = c.stream AND s.target_day = c.event_day),
windowed AS (SELECT stream, target_day, CAST(coalesce(event_count, 0) AS BIGINT) AS current_count,
       count(event_count) OVER w AS baseline_days,
       CAST(coalesce(sum(event_count) OVER w, 0) AS BIGINT) AS baseline_total
       FROM series WINDOW w AS (PARTITION BY stream ORDER BY d RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING)),
assessed AS (SELECT stream, target_day, current_count, baseline_days, baseline_total,
       CASE WHEN baseline_days = 7 THEN baseline_total / 7.0e0 END AS baseline_mean,
       CASE WHEN baseline_days = 7 THEN (current_count * 7 - baseline_total) / CAST(nullif(baseline_total, 0) AS DOUBLE) END
            AS relative_change,
       CASE WHEN baseline_days < 7 THEN 'insufficient_baseline'
            WHEN abs(current_count * 7 - baseline_total) * 2 > baseline_total THEN 'anomaly'
            ELSE 'ok' END AS status
       FROM windowed)"""


def _chain(select: str, extra: str) -> str:
    return O.with_chain("", []).replace("WITH ", "WITH ", 1).rstrip() + ",\n" + extra + "\n" + select


@register("daily_volume_counts", _chain("SELECT * FROM counts", _COUNTS))
def _q(c: Context):
    """Distinct (key, load_date) pairs per UTC day and stream (replays collapse)."""
    return MON.stream_daily_counts(c.vault)


@register("volume_anomaly", _chain(
    f"SELECT stream, target_day, current_count, baseline_days, baseline_total, "
    f"{O.rnd('baseline_mean', 6)} AS baseline_mean, {O.rnd('relative_change', 6)} AS relative_change, "
    f"status FROM assessed", _COUNTS + ",\n" + _ASSESS))
def _q(c: Context):
    """Every day of both streams against its trailing seven-day baseline."""
    return round_doubles(MON.assess_volume(MON.stream_daily_counts(c.vault)), 6)


@register("volume_status", _chain(
    "SELECT target_day, CASE max(CASE status WHEN 'anomaly' THEN 2 WHEN 'insufficient_baseline' THEN 1 "
    "ELSE 0 END) WHEN 2 THEN 'anomaly' WHEN 1 THEN 'insufficient_baseline' ELSE 'ok' END AS status "
    "FROM assessed GROUP BY target_day", _COUNTS + ",\n" + _ASSESS))
def _q(c: Context):
    """Overall status per day: anomaly > insufficient_baseline > ok."""
    return MON.merge_status(MON.assess_volume(MON.stream_daily_counts(c.vault)))


#: The day that the single-day monitor reads.
MONITOR_DAY = dt.date(2024, 1, 10)


@register("volume_day", _chain(
    f"SELECT stream, target_day, current_count, baseline_days, baseline_total, "
    f"{O.rnd('baseline_mean', 6)} AS baseline_mean, {O.rnd('relative_change', 6)} AS relative_change, status "
    f"FROM assessed WHERE target_day = DATE '{MONITOR_DAY}'", "counts AS (SELECT * FROM (" + _COUNTS.split("(", 1)[1]
    + f" WHERE event_day >= DATE '{MONITOR_DAY}' - 7 AND event_day <= DATE '{MONITOR_DAY}'),\n" + _ASSESS))
def _q(c: Context):
    """One day against its baseline, reading that range of days only."""
    return round_doubles(MON.assess_day(c.vault, MONITOR_DAY), 6)


@register("event_watermarks", O.with_chain(
    "SELECT 'interactions' AS stream, max(load_date) AS watermark FROM stg_interactions "
    "UNION ALL SELECT 'couriers', max(load_date) FROM stg_courier_telemetry"))
def _q(c: Context):
    return MON.event_watermarks(c.models)


_LOG = """ia AS (SELECT CAST(load_date AS DATE) AS day, max(load_date) AS mi FROM stg_interactions GROUP BY 1),
co AS (SELECT CAST(load_date AS DATE) AS day, max(load_date) AS mc FROM stg_courier_telemetry GROUP BY 1),
days AS (SELECT coalesce(ia.day, co.day) AS day, mi, mc FROM ia FULL JOIN co ON ia.day = co.day),
series AS (SELECT day, mi IS NOT NULL AS rel,
           max(mi) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS wm_interactions,
           max(mc) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS wm_couriers FROM days),
rlog AS (SELECT 'release-' || md5(CAST(day AS VARCHAR)) AS release_id, day,
         CAST(day + INTERVAL 1 DAY AS TIMESTAMP) AS built_at, wm_interactions, wm_couriers FROM series WHERE rel)"""


def _age(now: str, ts: str) -> str:
    return f"((epoch_us({now}) - epoch_us({ts})) / 1e6)"


def _written_log(c: Context):
    """A log with one activation per event day, written as events and read back."""
    root = checkpoint_path(c.spark, "release-history", uuid.uuid4().hex)
    REL.append_events(c.spark, root, REL.daily_activations(c.models))
    return REL.read_log(c.spark, root)


@register("release_freshness", _chain(
    f"""SELECT release_id, day, built_at, wm_interactions, wm_couriers, checked_at,
        {_age('checked_at', 'built_at')} AS build_age_seconds,
        {_age('checked_at', 'wm_interactions')} AS interactions_age_seconds,
        {_age('checked_at', 'wm_couriers')} AS couriers_age_seconds,
        CASE WHEN coalesce({_age('checked_at', 'built_at')} IS NULL OR {_age('checked_at', 'wm_interactions')} IS NULL
                  OR {_age('checked_at', 'wm_couriers')} IS NULL, false) THEN 'unknown'
             WHEN coalesce({_age('checked_at', 'built_at')} < -300 OR {_age('checked_at', 'wm_interactions')} < -300
                  OR {_age('checked_at', 'wm_couriers')} < -300, false) THEN 'clock_skew'
             WHEN coalesce({_age('checked_at', 'built_at')} > 7200 OR {_age('checked_at', 'wm_interactions')} > 86400
                  OR {_age('checked_at', 'wm_couriers')} > 86400, false) THEN 'stale'
             ELSE 'ok' END AS freshness_status
        FROM (SELECT *, built_at + INTERVAL 3600 SECOND AS checked_at FROM rlog)""", _LOG))
def _q(c: Context):
    """Freshness (build 2 h, events 1 day) of a publish-per-day log, checked 1 h after each build."""
    return REL.freshness_after(_written_log(c))


@register("release_prune_status", _chain(
    f"""SELECT release_id, built_at, retired_at,
        CASE WHEN replaced_at IS NULL THEN 'active' WHEN retired_at IS NULL THEN 'previous'
             WHEN {_age('now_', 'retired_at')} < {3 * 86400} THEN 'grace_period' ELSE 'eligible' END AS status
        FROM (SELECT release_id, built_at, lead(built_at, 1) OVER (ORDER BY built_at) AS replaced_at,
                     lead(built_at, 2) OVER (ORDER BY built_at) AS retired_at,
                     max(built_at) OVER () AS now_ FROM rlog)""", _LOG))
def _q(c: Context):
    """Retention status (3-day grace) of each release of the daily log, as of the latest build."""
    return REL.states(_written_log(c), F.lit(None).cast("timestamp_ntz"), 3 * 86400)


@register("snapshot_expiry", _chain(
    """SELECT release_id, built_at,
        (epoch_us(built_at) < epoch_us(now_) - CAST(7 * 86400 AS BIGINT) * 1000000 AND built_at <> now_) AS expire
        FROM (SELECT release_id, built_at, max(built_at) OVER () AS now_ FROM rlog)""", _LOG))
def _q(c: Context):
    """Snapshots older than seven days before the latest, never the current one."""
    return REL.snapshot_expiry(_written_log(c))


@register("cell_bits", O.with_chain(
    f"""SELECT h3_cell, h3_cell >> 56 AS resolution,
        ((h3_cell >> 28) & {(1 << 28) - 1}) - {1 << 27} AS q, (h3_cell & {(1 << 28) - 1}) - {1 << 27} AS r,
        (h3_cell >> 59) & 15 AS h3_mode, (h3_cell >> 52) & 15 AS h3_resolution, (h3_cell >> 45) & 127 AS h3_base_cell
        FROM (SELECT h3_res7 AS h3_cell FROM stg_interactions UNION SELECT h3_res9 FROM stg_interactions
              UNION SELECT h3_res7 FROM stg_courier_telemetry UNION SELECT h3_res9 FROM stg_courier_telemetry)
        WHERE h3_cell IS NOT NULL"""))
def _q(c: Context):
    """Bit fields of every cell id in use: lattice (res, q, r) and the H3 header fields."""
    si, st = c.models["stg_interactions"], c.models["stg_courier_telemetry"]
    cells = (si.select(F.col("h3_res7").alias("h3_cell")).unionByName(si.select(F.col("h3_res9").alias("h3_cell")))
             .unionByName(st.select(F.col("h3_res7").alias("h3_cell")))
             .unionByName(st.select(F.col("h3_res9").alias("h3_cell")))
             .filter(F.col("h3_cell").isNotNull()).distinct())
    return cells.select("h3_cell", SP.cell_resolution("h3_cell").alias("resolution"),
                        SP.cell_q("h3_cell").alias("q"), SP.cell_r("h3_cell").alias("r"),
                        SP.h3_mode("h3_cell").alias("h3_mode"), SP.h3_resolution("h3_cell").alias("h3_resolution"),
                        SP.h3_base_cell("h3_cell").alias("h3_base_cell"))

"""Registered queries (Spark) and their DuckDB oracles, keyed by the same name.

Every query reads the whole test tables through the surrogate streams; nothing is
sampled or capped except where a top-k limit *is* the feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexvault import oracle as O
from hexvault.functions.spatial import neighbour_cells_py
from hexvault.operators import vault as V
from hexvault.operators.serving import courier_response, hexagon_features
from hexvault.plans.context import Context, round_doubles

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
# Queries checked by row counts only (no SQL twin): stateful streaming, iterative models.
ROWS_ONLY: list[str] = []

# Fixed request parameters of the serving probes (the release verification point).
PROBE_LAT, PROBE_LON = 10.775, 106.7


_CONTEXTS: dict[tuple[int, str], Context] = {}


def context_for(spark: SparkSession, sf_dir: str) -> Context:
    """One lazily-built Context per (session, folder): plans are shared, no data is cached."""
    key = (id(spark), sf_dir)
    ctx = _CONTEXTS.get(key)
    if ctx is None or ctx.spark is not spark:
        ctx = _CONTEXTS[key] = Context(spark, sf_dir)
    return ctx


def register(name: str, oracle: str | None = None):
    def deco(fn: Callable[[Context], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(context_for(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        else:
            ROWS_ONLY.append(name)
        return fn
    return deco


def _sel(cols: list[str], table: str, where: str = "", rounded: list[str] = ()) -> str:
    parts = [O.rnd(c, 6) + f" AS {c}" if c in rounded else c for c in cols]
    return O.with_chain(f"SELECT {', '.join(parts)} FROM {table} {where}")


# --- vault sinks ---------------------------------------------------------------------

@register("vault_hub_user", _sel(["hk_user_id", "user_id", "load_date", "record_source"], "hub_user_v"))
def _q(c: Context):
    """Hub user rows, one per delivered click event (replays included)."""
    return c.vault["hub_user"]


@register("vault_hub_merchant",
          _sel(["hk_merchant_id", "merchant_id", "load_date", "record_source"], "hub_merchant_v"))
def _q(c: Context):
    return c.vault["hub_merchant"]


@register("vault_hub_courier",
          _sel(["hk_courier_id", "courier_id", "load_date", "record_source"], "hub_courier_v"))
def _q(c: Context):
    return c.vault["hub_courier"]


@register("vault_link_interaction",
          _sel(["hk_interaction_id", "hk_user_id", "hk_merchant_id", "load_date", "record_source"],
               "link_v"))
def _q(c: Context):
    return c.vault["link_user_merchant_interaction"]


_SAT_I = ["hk_interaction_id", "load_date", "event_type", "device_type", "dwell_time_ms",
          "referrer_page", "latitude", "longitude", "h3_res7", "h3_res9", "record_source"]
_WKB_SQL = ("hex(st_aswkb(('POINT (' || CAST(longitude AS VARCHAR) || ' ' || "
            "CAST(latitude AS VARCHAR) || ')')::geometry)) AS geom_wkb_hex")


@register("vault_sat_interaction", O.with_chain(
    f"SELECT {', '.join(_SAT_I)}, {_WKB_SQL} FROM sat_i_v"))
def _q(c: Context):
    """Interaction satellite with cells and the WKB point (compared as hex text)."""
    sat = c.vault["sat_interaction_context_spatial"]
    return sat.select(*_SAT_I, F.hex("geom_wkb").alias("geom_wkb_hex"))


_SAT_C = ["hk_courier_id", "load_date", "latitude", "longitude", "speed_kmh", "bearing_deg", "status",
          "h3_res7", "h3_res9", "record_source"]


@register("vault_sat_courier", O.with_chain(f"SELECT {', '.join(_SAT_C)}, {_WKB_SQL} FROM sat_c_v"))
def _q(c: Context):
    sat = c.vault["sat_courier_telemetry_spatial"]
    return sat.select(*_SAT_C, F.hex("geom_wkb").alias("geom_wkb_hex"))


_LIVE = ["hk_courier_id", "courier_id", "latitude", "longitude", "speed_kmh", "bearing_deg",
         "status", "h3_res7", "h3_res9", "event_ts_ms"]
_LIVE_ORDER = ("event_ts_ms DESC NULLS LAST, status ASC NULLS FIRST, latitude ASC NULLS FIRST, "
               "longitude ASC NULLS FIRST, speed_kmh ASC NULLS FIRST, bearing_deg ASC NULLS FIRST, "
               "h3_res7 ASC NULLS FIRST, h3_res9 ASC NULLS FIRST")


@register("live_courier_upsert", O.with_chain(
    f"SELECT {', '.join(_LIVE)} FROM (SELECT *, row_number() OVER (PARTITION BY hk_courier_id "
    f"ORDER BY {_LIVE_ORDER}) AS rn FROM (SELECT {O.hk('courier_id')} AS hk_courier_id, courier_id, "
    f"latitude, longitude, speed_kmh, bearing_deg, status, "
    f"{O.hexcell('latitude', 'longitude', 7)} AS h3_res7, "
    f"{O.hexcell('latitude', 'longitude', 9)} AS h3_res9, event_ts_ms FROM telemetry)) WHERE rn = 1"))
def _q(c: Context):
    """Keyed live table: latest ping per courier by event time (total tie-break order)."""
    from hexvault.streaming.sinks import latest_live_rows
    return latest_live_rows(V.courier_live_rows(c.pings))


_LOG = ["hk_interaction_id", "user_id", "merchant_id", "event_type", "device_type", "dwell_time_ms",
        "latitude", "longitude", "h3_res7", "h3_res9", "event_ts_ms"]


@register("clickstream_log", O.with_chain(
    f"SELECT {O.composite('user_id', 'merchant_id', 'CAST(event_ts_ms AS VARCHAR)')} AS hk_interaction_id, "
    f"user_id, merchant_id, event_type, device_type, dwell_time_ms, latitude, longitude, "
    f"{O.hexcell('latitude', 'longitude', 7)} AS h3_res7, {O.hexcell('latitude', 'longitude', 9)} AS h3_res9, "
    f"event_ts_ms FROM clickstream"))
def _q(c: Context):
    return V.clickstream_log(c.clicks)


# --- staging and marts ---------------------------------------------------------------

for _name in ("stg_users", "stg_merchants", "stg_couriers", "stg_interaction_links",
              "stg_interactions", "stg_courier_telemetry", "current_courier_positions",
              "fct_interactions", "mart_user_merchant_affinity"):
    def _make(model: str):
        def fn(c: Context):
            return c.models[model]
        fn.__doc__ = f"Model {model} rebuilt from the whole vault."
        return fn
    register(_name, O.with_chain(f"SELECT * FROM {_name}"))(_make(_name))

_MART_COLS = ["h3_cell", "resolution", "event_hour", "event_type", "event_count",
              "total_dwell_time_ms", "dwell_sample_count", "centroid_latitude", "centroid_longitude"]


@register("mart_cell_demand_hourly", _sel(_MART_COLS, "mart_h3_demand_hourly",
                                          rounded=["centroid_latitude", "centroid_longitude"]))
def _q(c: Context):
    """Hourly cell demand mart (centroids rounded to 6 digits for comparison)."""
    return round_doubles(c.models["mart_h3_demand_hourly"], 6)


# --- serving -------------------------------------------------------------------------

@register("raw_interactions", O.with_chain("SELECT * FROM raw_interactions"))
def _q(c: Context):
    """Raw-mode interactions: de-duplicated satellite ⋈ link ⋈ merchant hub."""
    return c.raw.interactions()


@register("raw_couriers", O.with_chain("SELECT * FROM raw_couriers"))
def _q(c: Context):
    return c.raw.couriers()


def _recommend_sql(source: str, cells: list[int] | None, limit: int) -> str:
    where = "latitude IS NOT NULL AND longitude IS NOT NULL"
    if cells:
        where += f" AND h3_res7 IN ({', '.join(str(x) for x in cells)})"
    lat, lon = O.emean("latitude"), O.emean("longitude")
    dist = O.rnd(O.haversine(lat, lon, repr(PROBE_LAT), repr(PROBE_LON)), 1)
    merchants = f"""SELECT merchant_id, count(*) AS interaction_count,
        {O.rnd(lat, 6)} AS avg_lat, {O.rnd(lon, 6)} AS avg_lon,
        {O.hexl('max(h3_res7)')} AS sample_h3_res7, {dist} AS dist_meters
        FROM {source} WHERE {where} GROUP BY merchant_id"""
    score = O.rnd("interaction_count / (1.0e0 + coalesce(dist_meters, 1000.0e0) / 2000.0e0)", 2)
    return (f"SELECT *, {score} AS score FROM ({merchants}) "
            f"ORDER BY score DESC, interaction_count DESC, merchant_id LIMIT {limit}")


@register("recommend_merchants", O.with_chain(_recommend_sql("fct_interactions", None, 10)))
def _q(c: Context):
    """Top-10 merchants for the probe point over the marts (no neighbour restriction)."""
    return c.mart.recommendations(PROBE_LAT, PROBE_LON, 10)


_NEAR = neighbour_cells_py(PROBE_LAT, PROBE_LON, 7)


@register("recommend_near_with_fallback", O.with_chain(
    f"""SELECT *, row_number() OVER (ORDER BY score DESC, interaction_count DESC, merchant_id) AS rank
        FROM (SELECT merchant_id, interaction_count, avg_lat, avg_lon, sample_h3_res7,
                     coalesce(dist_meters, 1000.0e0) AS dist_meters, score
              FROM (SELECT *, min(src) OVER () AS keep FROM (
                   SELECT *, 0 AS src FROM ({_recommend_sql('raw_interactions', _NEAR, 10)})
                   UNION ALL
                   SELECT *, 1 AS src FROM ({_recommend_sql('raw_interactions', None, 10)})))
              WHERE src = keep)"""))
def _q(c: Context):
    """Neighbour-restricted ranking in raw mode, global fallback only when empty."""
    return c.raw.recommend_near_with_fallback(PROBE_LAT, PROBE_LON, 10)


def _hex_mart_sql(res: int, limit: int) -> str:
    n = "event_count"
    return O.with_chain(f"""SELECT {O.hexl('h3_cell')} AS h3_hex, CAST(sum({n}) AS BIGINT) AS metric_count,
        {O.rnd(O.ewmean('centroid_latitude', n), 6)} AS centroid_lat,
        {O.rnd(O.ewmean('centroid_longitude', n), 6)} AS centroid_lon,
        {O.rnd('sum(total_dwell_time_ms) / nullif(sum(dwell_sample_count), 0)', 6)} AS avg_dwell_ms
        FROM mart_h3_demand_hourly WHERE resolution = {res}
        GROUP BY h3_cell ORDER BY metric_count DESC, h3_hex LIMIT {limit}""")


@register("hexagons_mart_res7", _hex_mart_sql(7, 100))
def _q(c: Context):
    """Top cells at res 7 from the hourly mart (weighted re-aggregation of partials)."""
    return round_doubles(c.mart.hexagons("interactions", 7, 100), 6)


@register("hexagon_features", "SELECT h3_hex, metric_count AS count, centroid_lon, centroid_lat, "
          f"coalesce(avg_dwell_ms, 0) AS avg_dwell_ms FROM ({_hex_mart_sql(7, 100)}) WHERE h3_hex IS NOT NULL")
def _q(c: Context):
    """The hexagon response: centroid pair and properties, null cells left out, a missing metric as 0."""
    shaped = hexagon_features(c.mart.hexagons("interactions", 7, 100)).select(
        "h3_hex", "count", F.col("centroid")[0].alias("centroid_lon"), F.col("centroid")[1].alias("centroid_lat"),
        "properties.avg_dwell_ms")
    return round_doubles(shaped, 6)


@register("hexagons_mart_res9", _hex_mart_sql(9, 100))
def _q(c: Context):
    return round_doubles(c.mart.hexagons("interactions", 9, 100), 6)


@register("hexagons_raw_res7", O.with_chain(f"""SELECT {O.hexl('h3_res7')} AS h3_hex, count(*) AS metric_count,
        {O.rnd(O.emean('latitude'), 6)} AS centroid_lat, {O.rnd(O.emean('longitude'), 6)} AS centroid_lon,
        {O.rnd(O.emean('dwell_time_ms'), 6)} AS avg_dwell_ms
        FROM (SELECT DISTINCT hk_interaction_id, load_date, latitude, longitude, h3_res7, h3_res9,
                     dwell_time_ms, event_type, device_type, referrer_page FROM sat_i_v)
        WHERE h3_res7 IS NOT NULL GROUP BY h3_res7 ORDER BY metric_count DESC, h3_hex LIMIT 100"""))
def _q(c: Context):
    return round_doubles(c.raw.hexagons("interactions", 7, 100), 6)


@register("hexagons_couriers_res7", O.with_chain(f"""SELECT {O.hexl('h3_res7')} AS h3_hex,
        count(*) AS metric_count, {O.rnd(O.emean('latitude'), 6)} AS centroid_lat,
        {O.rnd(O.emean('longitude'), 6)} AS centroid_lon, {O.rnd(O.emean('speed_kmh'), 6)} AS avg_speed_kmh,
        count(*) AS active_couriers
        FROM current_courier_positions WHERE h3_res7 IS NOT NULL
        GROUP BY h3_res7 ORDER BY metric_count DESC, h3_hex LIMIT 100"""))
def _q(c: Context):
    return round_doubles(c.mart.hexagons("couriers", 7, 100), 6)


def _live_sql(status: str | None) -> str:
    pred = f" AND status = '{status}'" if status else ""
    return O.with_chain(f"""SELECT courier_id, latitude, longitude, speed_kmh, bearing_deg, status,
        {O.hexl('h3_res7')} AS h3_res7, {O.hexl('h3_res9')} AS h3_res9, load_date
        FROM current_courier_positions WHERE h3_res7 IS NOT NULL{pred}
        ORDER BY load_date DESC, courier_id LIMIT 50""")


@register("live_couriers_all", _live_sql(None))
def _q(c: Context):
    return c.mart.live_couriers(None, 50)


@register("courier_response", "SELECT * REPLACE (coalesce(speed_kmh, 0.0) AS speed_kmh, "
          f"coalesce(bearing_deg, 0) AS bearing_deg) FROM ({_live_sql(None)})")
def _q(c: Context):
    """The courier response: missing speed and bearing as 0."""
    return courier_response(c.mart.live_couriers(None, 50))


@register("live_couriers_idle", _live_sql("idle"))
def _q(c: Context):
    """Idle couriers; the status filter applies after latest-position selection."""
    return c.mart.live_couriers("idle", 50)


@register("table_stats", O.with_chain(" UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {t}" for n, t in [
        ("hub_user", "hub_user_v"), ("hub_merchant", "hub_merchant_v"), ("hub_courier", "hub_courier_v"),
        ("link_user_merchant_interaction", "link_v"), ("sat_interaction_context_spatial", "sat_i_v"),
        ("sat_courier_telemetry_spatial", "sat_c_v")])))
def _q(c: Context):
    """Row counts of the six raw vault tables."""
    return c.raw.stats()


# --- the same serving shapes in the other mode / resolution ------------------------------

@register("recommend_merchants_raw", O.with_chain(_recommend_sql("raw_interactions", None, 10)))
def _q(c: Context):
    """Top-10 merchants for the probe point over the raw vault (deduplicated before joins)."""
    return c.raw.recommendations(PROBE_LAT, PROBE_LON, 10)


@register("hexagons_raw_res9", O.with_chain(f"""SELECT {O.hexl('h3_res9')} AS h3_hex, count(*) AS metric_count,
        {O.rnd(O.emean('latitude'), 6)} AS centroid_lat, {O.rnd(O.emean('longitude'), 6)} AS centroid_lon,
        {O.rnd(O.emean('dwell_time_ms'), 6)} AS avg_dwell_ms
        FROM (SELECT DISTINCT hk_interaction_id, load_date, latitude, longitude, h3_res7, h3_res9,
                     dwell_time_ms, event_type, device_type, referrer_page FROM sat_i_v)
        WHERE h3_res9 IS NOT NULL GROUP BY h3_res9 ORDER BY metric_count DESC, h3_hex LIMIT 100"""))
def _q(c: Context):
    return round_doubles(c.raw.hexagons("interactions", 9, 100), 6)


@register("hexagons_couriers_res9", O.with_chain(f"""SELECT {O.hexl('h3_res9')} AS h3_hex,
        count(*) AS metric_count, {O.rnd(O.emean('latitude'), 6)} AS centroid_lat,
        {O.rnd(O.emean('longitude'), 6)} AS centroid_lon, {O.rnd(O.emean('speed_kmh'), 6)} AS avg_speed_kmh,
        count(*) AS active_couriers
        FROM raw_couriers WHERE h3_res9 IS NOT NULL
        GROUP BY h3_res9 ORDER BY metric_count DESC, h3_hex LIMIT 100"""))
def _q(c: Context):
    """Courier cells at res 9 from the raw vault (latest ping per courier, total order)."""
    return round_doubles(c.raw.hexagons("couriers", 9, 100), 6)


@register("live_couriers_delivering", _live_sql("delivering"))
def _q(c: Context):
    return c.mart.live_couriers("delivering", 50)


@register("table_stats_mart", O.with_chain(" UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {t}" for n, t in [
        ("hub_user", "stg_users"), ("hub_merchant", "stg_merchants"), ("hub_courier", "stg_couriers"),
        ("link_user_merchant_interaction", "stg_interaction_links"),
        ("sat_interaction_context_spatial", "stg_interactions"),
        ("sat_courier_telemetry_spatial", "stg_courier_telemetry")])))
def _q(c: Context):
    """Row counts of the staged tables (mart mode: replays collapsed)."""
    return c.mart.stats()


# Further query groups register themselves on import.
from hexvault.plans import quality_queries  # noqa: E402,F401
from hexvault.plans import monitor_queries  # noqa: E402,F401
from hexvault.plans import contract_queries  # noqa: E402,F401
from hexvault.plans import streaming_queries  # noqa: E402,F401
from hexvault.plans import designed_queries  # noqa: E402,F401
from hexvault.plans import stored_queries  # noqa: E402,F401
from hexvault.plans import model_queries  # noqa: E402,F401

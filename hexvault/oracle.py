"""DuckDB twins of the registered queries (the correctness oracle).

Each query is a ``WITH`` chain over the pre-registered parquet views that rebuilds
the same surrogate streams, vault, staging and marts in plain SQL, followed by the
query itself. Column names equal the Spark results; floating outputs are rounded
the same way on both sides (``floor(x·10^d + 0.5) / 10^d``).
"""

from __future__ import annotations

from hexvault.functions.hashing import PY_WHITESPACE
from hexvault.functions.spatial import (AXIS_BITS, AXIS_OFFSET, EARTH_RADIUS_EQUAL_AREA,
                                        RES_SHIFT, SPHERE_RADIUS_M, SQRT3_OVER_3, hex_size)

_WS = "".join(f"' || chr({ord(ch)}) || '" for ch in PY_WHITESPACE)


def strip(x: str) -> str:
    return f"trim(CAST({x} AS VARCHAR), '{_WS}')"


def hk(x: str) -> str:
    return f"upper(md5({strip(x)}))"


def composite(*parts: str) -> str:
    miss = " OR ".join(f"({p}) IS NULL OR CAST({p} AS VARCHAR) = ''" for p in parts)
    token = " || ';' || ".join(strip(p) for p in parts)
    return f"(CASE WHEN {miss} THEN NULL ELSE upper(md5({token})) END)"


def hexcell(lat: str, lon: str, res: int) -> str:
    s = repr(hex_size(res))
    R = repr(EARTH_RADIUS_EQUAL_AREA)
    x = f"({R} * radians({lon}))"
    y = f"({R} * sin(radians({lat})))"
    qf = f"(({SQRT3_OVER_3!r} * {x} - {y} / 3.0e0) / {s})"
    rf = f"(({2.0 / 3.0!r} * {y}) / {s})"
    sf = f"(-{qf} - {rf})"
    rq, rr, rs = (f"floor({qf} + 0.5e0)", f"floor({rf} + 0.5e0)", f"floor({sf} + 0.5e0)")
    dq, dr, ds = (f"abs({rq} - {qf})", f"abs({rr} - {rf})", f"abs({rs} - {sf})")
    q = f"(CASE WHEN {dq} > {dr} AND {dq} > {ds} THEN -{rs} - {rr} ELSE {rq} END)"
    r = (f"(CASE WHEN {dq} > {dr} AND {dq} > {ds} THEN {rr} WHEN {dr} > {ds} "
         f"THEN -{rq} - {rs} ELSE {rr} END)")
    packed = (f"(CAST({res} AS BIGINT) * CAST({2 ** RES_SHIFT} AS BIGINT) "
              f"+ (CAST({q} AS BIGINT) + {AXIS_OFFSET}) * CAST({2 ** AXIS_BITS} AS BIGINT) "
              f"+ (CAST({r} AS BIGINT) + {AXIS_OFFSET}))")
    return f"(CASE WHEN {lat} IS NULL OR {lon} IS NULL THEN NULL ELSE {packed} END)"


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"(pow(sin(radians({lat2} - {lat1}) / 2.0e0), 2) + cos(radians({lat1})) * "
         f"cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2.0e0), 2))")
    return f"({2.0 * SPHERE_RADIUS_M!r} * asin(sqrt({a})))"


def rnd(x: str, digits: int) -> str:
    scale = repr(float(10 ** digits))
    return f"(floor(({x}) * {scale} + 0.5e0) / {scale})"


def emean(x: str) -> str:
    """Exact-decimal mean (twin of ``numeric.exact_mean``)."""
    return f"(CAST(sum(CAST({x} AS DECIMAL(38,9))) AS DOUBLE) / nullif(count({x}), 0))"


def ewmean(v: str, w: str) -> str:
    """Exact weighted mean (twin of ``numeric.exact_weighted_mean``)."""
    return (f"(CAST(sum(CAST({v} AS DECIMAL(38,9)) * CAST({w} AS DECIMAL(20,0))) AS DOUBLE)"
            f" / CAST(nullif(sum({w}), 0) AS DOUBLE))")


def hexl(x: str) -> str:
    return f"lower(hex({x}))"


def load_date(ms: str = "event_ts_ms") -> str:
    return f"make_timestamp(CAST({ms} AS BIGINT) * 1000)"


# ---------------------------------------------------------------------------------
# The CTE chain: surrogates → vault → staging → marts.

def _pick(index: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {index} = {i} THEN '{v}'" for i, v in enumerate(values))
    return f"(CASE {arms} END)"


def padded(prefix: str, number: str, width: int) -> str:
    """Twin of ``tables.padded_id``: pads up to the width, never cuts."""
    text = f"CAST({number} AS VARCHAR)"
    return f"'{prefix}' || lpad({text}, greatest(length({text}), {width})::INT, '0')"


def base_ctes() -> list[tuple[str, str]]:
    from hexvault.sources.tables import (BASE_LAT, BASE_LON, COORD_MOD, COORD_STEP, DEVICE_TYPES,
                                         EVENT_TYPE_MAP, MERCHANT_MOD, REFERRER_PAGES,
                                         REPLAY_EVERY, STATUS_BY_FLAGS)
    etype = "CASE " + " ".join(f"WHEN event_type = '{a}' THEN '{b}'" for a, b in EVENT_TYPE_MAP) \
        + " ELSE event_type END"
    k = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
    click_once = f"""
        SELECT CAST(event_id AS VARCHAR) AS event_id,
               {padded('USR_', 'user_id', 6)} AS user_id,
               {padded('ITM_', k, 5)} AS item_id,
               {padded('MCH_', f'{k} % {MERCHANT_MOD}', 4)} AS merchant_id,
               {etype} AS event_type,
               {_pick('event_id % 3', DEVICE_TYPES)} AS device_type,
               CAST(floor(value * 100.0e0) AS BIGINT) AS dwell_time_ms,
               {_pick('user_id % 4', REFERRER_PAGES)} AS referrer_page,
               {BASE_LAT!r} + (event_id % {COORD_MOD}) / {COORD_STEP!r} AS latitude,
               {BASE_LON!r} + ((user_id * 37 + event_id * 13) % {COORD_MOD}) / {COORD_STEP!r} AS longitude,
               epoch_us(ts) // 1000 AS event_ts_ms
        FROM events"""
    clickstream = f"""
        SELECT * FROM click_once
        UNION ALL
        SELECT * FROM click_once WHERE CAST(event_id AS BIGINT) % {REPLAY_EVERY} = 0"""
    status = "CASE " + " ".join(
        (f"WHEN l_returnflag = '{rf}' THEN '{v}'" if ls is None else
         f"WHEN l_returnflag = '{rf}' AND l_linestatus = '{ls}' THEN '{v}'")
        for rf, ls, v in STATUS_BY_FLAGS) + " END"
    telemetry = f"""
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS telemetry_id,
               {padded('DRV_', 'l_suppkey', 4)} AS courier_id,
               CASE WHEN l_linenumber % 3 = 0 THEN NULL
                    ELSE {padded('ORD_', 'l_orderkey', 8)} END AS order_id,
               {BASE_LAT!r} + (l_partkey % {COORD_MOD}) / {COORD_STEP!r} AS latitude,
               {BASE_LON!r} + (l_orderkey % {COORD_MOD}) / {COORD_STEP!r} AS longitude,
               CAST(l_quantity AS DOUBLE) AS speed_kmh,
               CAST(l_partkey % 360 AS INTEGER) AS bearing_deg,
               {status} AS status,
               epoch_us(l_shipdate) // 1000 AS event_ts_ms
        FROM lineitem"""
    ikey = composite("user_id", "merchant_id", "CAST(event_ts_ms AS VARCHAR)")
    wkb_null = "CAST(NULL AS BLOB)"
    ctes = [
        ("click_once", click_once),
        ("clickstream", clickstream),
        ("telemetry", telemetry),
        ("hub_user_v", f"SELECT {hk('user_id')} AS hk_user_id, user_id, {load_date()} AS load_date, "
                       f"'events.clickstream' AS record_source FROM clickstream"),
        ("hub_merchant_v", f"SELECT {hk('merchant_id')} AS hk_merchant_id, merchant_id, "
                           f"{load_date()} AS load_date, 'events.clickstream' AS record_source FROM clickstream"),
        ("hub_courier_v", f"SELECT {hk('courier_id')} AS hk_courier_id, courier_id, {load_date()} AS load_date, "
                          f"'events.telemetry' AS record_source FROM telemetry"),
        ("link_v", f"SELECT {ikey} AS hk_interaction_id, {hk('user_id')} AS hk_user_id, "
                   f"{hk('merchant_id')} AS hk_merchant_id, {load_date()} AS load_date, "
                   f"'events.clickstream' AS record_source FROM clickstream"),
        ("sat_i_v", f"""SELECT {ikey} AS hk_interaction_id, {load_date()} AS load_date, event_type,
                   device_type, dwell_time_ms, referrer_page, latitude, longitude,
                   {hexcell('latitude', 'longitude', 7)} AS h3_res7,
                   {hexcell('latitude', 'longitude', 9)} AS h3_res9,
                   {wkb_null} AS geom_wkb, 'events.clickstream' AS record_source FROM clickstream"""),
        ("sat_c_v", f"""SELECT {hk('courier_id')} AS hk_courier_id, {load_date()} AS load_date,
                   latitude, longitude, speed_kmh, bearing_deg, status,
                   {hexcell('latitude', 'longitude', 7)} AS h3_res7,
                   {hexcell('latitude', 'longitude', 9)} AS h3_res9,
                   {wkb_null} AS geom_wkb, 'events.telemetry' AS record_source FROM telemetry"""),
        ("stg_users", "SELECT hk_user_id, user_id, min(load_date) AS first_seen_at FROM hub_user_v "
                      "GROUP BY hk_user_id, user_id"),
        ("stg_merchants", "SELECT hk_merchant_id, merchant_id, min(load_date) AS first_seen_at "
                          "FROM hub_merchant_v GROUP BY hk_merchant_id, merchant_id"),
        ("stg_couriers", "SELECT hk_courier_id, courier_id, min(load_date) AS first_seen_at "
                         "FROM hub_courier_v GROUP BY hk_courier_id, courier_id"),
        ("stg_interaction_links", "SELECT hk_interaction_id, hk_user_id, hk_merchant_id, "
                                  "min(load_date) AS first_seen_at FROM link_v "
                                  "GROUP BY hk_interaction_id, hk_user_id, hk_merchant_id"),
        ("stg_interactions", "SELECT DISTINCT hk_interaction_id, load_date, event_type, device_type, "
                             "dwell_time_ms, referrer_page, latitude, longitude, h3_res7, h3_res9 "
                             "FROM sat_i_v"),
        ("stg_courier_telemetry", "SELECT DISTINCT hk_courier_id, load_date, latitude, longitude, "
                                  "speed_kmh, bearing_deg, status, h3_res7, h3_res9 FROM sat_c_v"),
        ("ranked_positions", f"""SELECT *, row_number() OVER (PARTITION BY hk_courier_id
                   ORDER BY {POSITION_ORDER}) AS position_rank FROM stg_courier_telemetry"""),
        ("current_courier_positions", """SELECT s.hk_courier_id, c.courier_id, s.load_date, s.latitude,
                   s.longitude, s.speed_kmh, s.bearing_deg, s.status, s.h3_res7, s.h3_res9
                   FROM ranked_positions s JOIN stg_couriers c ON s.hk_courier_id = c.hk_courier_id
                   WHERE position_rank = 1"""),
        ("fct_interactions", """SELECT s.hk_interaction_id, l.hk_user_id, l.hk_merchant_id, u.user_id,
                   m.merchant_id, s.load_date AS event_at, s.event_type, s.device_type,
                   s.dwell_time_ms, s.referrer_page, s.latitude, s.longitude, s.h3_res7, s.h3_res9
                   FROM stg_interactions s
                   JOIN stg_interaction_links l ON s.hk_interaction_id = l.hk_interaction_id
                   JOIN stg_users u ON l.hk_user_id = u.hk_user_id
                   JOIN stg_merchants m ON l.hk_merchant_id = m.hk_merchant_id"""),
        ("mart_cells", """SELECT date_trunc('hour', event_at) AS event_hour, 7 AS resolution,
                   h3_res7 AS h3_cell, event_type, dwell_time_ms, latitude, longitude
                   FROM fct_interactions WHERE h3_res7 IS NOT NULL
                   UNION ALL
                   SELECT date_trunc('hour', event_at), 9, h3_res9, event_type, dwell_time_ms,
                   latitude, longitude FROM fct_interactions WHERE h3_res9 IS NOT NULL"""),
        ("mart_h3_demand_hourly", f"""SELECT h3_cell, resolution, event_hour, event_type,
                   count(*) AS event_count, CAST(sum(dwell_time_ms) AS BIGINT) AS total_dwell_time_ms,
                   count(dwell_time_ms) AS dwell_sample_count, {emean('latitude')} AS centroid_latitude,
                   {emean('longitude')} AS centroid_longitude
                   FROM mart_cells GROUP BY h3_cell, resolution, event_hour, event_type"""),
        ("mart_user_merchant_affinity", """SELECT hk_user_id, hk_merchant_id, count(*) AS interaction_count,
                   CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchase_count,
                   max(event_at) AS last_interaction_at
                   FROM fct_interactions GROUP BY hk_user_id, hk_merchant_id"""),
        # raw-mode serving inputs
        ("raw_interactions", """SELECT s.*, m.merchant_id FROM
                   (SELECT DISTINCT hk_interaction_id, load_date, latitude, longitude, h3_res7, h3_res9,
                           dwell_time_ms, event_type, device_type, referrer_page FROM sat_i_v) s
                   JOIN (SELECT DISTINCT hk_interaction_id, hk_merchant_id FROM link_v) l
                     ON s.hk_interaction_id = l.hk_interaction_id
                   JOIN (SELECT DISTINCT hk_merchant_id, merchant_id FROM hub_merchant_v) m
                     ON l.hk_merchant_id = m.hk_merchant_id"""),
        ("raw_ranked", f"""SELECT *, row_number() OVER (PARTITION BY hk_courier_id
                   ORDER BY {POSITION_ORDER}) AS position_rank FROM sat_c_v"""),
        ("raw_couriers", """SELECT s.hk_courier_id, c.courier_id, s.load_date, s.latitude, s.longitude,
                   s.speed_kmh, s.bearing_deg, s.status, s.h3_res7, s.h3_res9
                   FROM raw_ranked s
                   JOIN (SELECT DISTINCT hk_courier_id, courier_id FROM hub_courier_v) c
                     ON s.hk_courier_id = c.hk_courier_id
                   WHERE s.position_rank = 1"""),
    ]
    return ctes


POSITION_ORDER = ("load_date DESC NULLS LAST, status ASC NULLS FIRST, latitude ASC NULLS FIRST, "
                  "longitude ASC NULLS FIRST, speed_kmh ASC NULLS FIRST, "
                  "bearing_deg ASC NULLS FIRST, h3_res7 ASC NULLS FIRST, h3_res9 ASC NULLS FIRST")


def with_chain(select: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` all base CTEs (+ extra) followed by the final ``select``."""
    ctes = base_ctes() + list(extra or [])
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes)
    return f"WITH {body}\n{select}"


# ---------------------------------------------------------------------------------
# Quality tests (twins of hexvault.operators.quality).

MODEL_VIEWS = {
    "hub_user": "hub_user_v", "hub_merchant": "hub_merchant_v", "hub_courier": "hub_courier_v",
    "link_user_merchant_interaction": "link_v", "sat_interaction_context_spatial": "sat_i_v",
    "sat_courier_telemetry_spatial": "sat_c_v",
}


def view(model: str) -> str:
    return MODEL_VIEWS.get(model, model)


def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


SINGULAR_SQL = {
    "valid_interaction_coordinates": """SELECT hk_interaction_id FROM stg_interactions
        WHERE coalesce(latitude IS NULL OR longitude IS NULL OR NOT (latitude BETWEEN -90 AND 90)
              OR NOT (longitude BETWEEN -180 AND 180) OR dwell_time_ms < 0, false)""",
    "valid_courier_coordinates": """SELECT hk_courier_id FROM stg_courier_telemetry
        WHERE coalesce(latitude IS NULL OR longitude IS NULL OR NOT (latitude BETWEEN -90 AND 90)
              OR NOT (longitude BETWEEN -180 AND 180) OR speed_kmh < 0 OR bearing_deg < 0
              OR bearing_deg >= 360, false)""",
    "fact_preserves_interactions": """SELECT s.hk_interaction_id FROM stg_interactions s
        WHERE NOT EXISTS (SELECT 1 FROM fct_interactions f WHERE f.hk_interaction_id = s.hk_interaction_id)""",
    "h3_rollup_conserves_counts": """SELECT e.resolution FROM
        (SELECT 7 AS resolution, count(h3_res7) AS events FROM fct_interactions
         UNION ALL SELECT 9, count(h3_res9) FROM fct_interactions) e
        LEFT JOIN (SELECT resolution, sum(event_count) AS events FROM mart_h3_demand_hourly
                   GROUP BY resolution) a ON e.resolution = a.resolution
        WHERE e.events <> coalesce(a.events, 0)""",
}

_DUCK_TYPES = {"VARCHAR": "STRING", "BIGINT": "BIGINT", "INTEGER": "INT", "DOUBLE": "DOUBLE",
               "TIMESTAMP": "TIMESTAMP", "BLOB": "VARBINARY"}


def violation_rows_sql(test) -> str:
    m = view(test.model)
    if test.kind == "not_null":
        return f"SELECT * FROM {m} WHERE {test.column} IS NULL"
    if test.kind == "unique":
        return (f"SELECT {test.column} AS unique_field, count(*) AS n_records FROM {m} "
                f"WHERE {test.column} IS NOT NULL GROUP BY {test.column} HAVING count(*) > 1")
    if test.kind == "unique_combination":
        cols = ", ".join(test.args["columns"])
        return f"SELECT {cols}, count(*) AS row_count FROM {m} GROUP BY {cols} HAVING count(*) > 1"
    if test.kind == "accepted_values":
        vals = ", ".join(_lit(v) for v in test.args["values"])
        return (f"SELECT value_field, n_records FROM (SELECT {test.column} AS value_field, "
                f"count(*) AS n_records FROM {m} GROUP BY {test.column}) "
                f"WHERE value_field IS NOT NULL AND value_field NOT IN ({vals})")
    if test.kind == "relationships":
        p, f = view(test.args["to"]), test.args["field"]
        return (f"SELECT c.{test.column} AS from_field, count(*) AS n_records FROM {m} c "
                f"WHERE c.{test.column} IS NOT NULL "
                f"AND NOT EXISTS (SELECT 1 FROM {p} p WHERE p.{f} = c.{test.column}) GROUP BY c.{test.column}")
    if test.kind == "schema_conforms":
        checks = []
        for name, allowed in test.args["types"].items():
            mapped = " ".join(f"WHEN typeof({name}) = '{d}' THEN '{s}'" for d, s in _DUCK_TYPES.items())
            allowed_sql = ", ".join(f"'{a}'" for a in allowed)
            checks.append(f"(CASE {mapped} ELSE typeof({name}) END) NOT IN ({allowed_sql})")
        return f"SELECT 1 FROM (SELECT * FROM {m} LIMIT 1) WHERE {' OR '.join(checks)}"
    if test.kind == "singular":
        return SINGULAR_SQL[test.model]
    raise ValueError(test)


def gate_sql(tests) -> str:
    def count(t) -> str:
        return "CAST(coalesce(sum(n_records), 0) AS BIGINT)" if t.kind == "relationships" else "count(*)"
    parts = [f"SELECT '{t.name}' AS test_name, '{t.kind}' AS kind, '{t.model}' AS model, "
             f"{count(t)} AS violations FROM ({violation_rows_sql(t)})" for t in tests]
    return with_chain(" UNION ALL ".join(parts))

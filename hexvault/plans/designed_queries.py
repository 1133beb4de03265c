"""Registered queries of the designed operators (documented extensions of the vault)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hexvault import oracle as O
from hexvault.operators import features as D
from hexvault.plans.context import Context, round_doubles
from hexvault.plans.registry import register

NN = "'^^NULL^^'"


def _std(cols: list[str]) -> str:
    parts = [f"upper(trim(coalesce(CAST({c} AS VARCHAR), {NN})))" for c in sorted(cols)]
    return f"md5({' || chr(31) || '.join(parts)})"


_CAT = ("cwc AS (SELECT c.*, p.p_type AS category FROM click_once c LEFT JOIN part p "
        "ON CAST(substring(c.item_id, 5) AS BIGINT) = p.p_partkey - 1)")


def _q(select: str, extra: str = "") -> str:
    base = O.with_chain("", []).rstrip()
    return base + (",\n" + extra if extra else "") + "\n" + select


@register("d_hash_std", _q(f"SELECT event_id, {_std(['event_ts_ms', 'item_id', 'user_id'])} AS hk_interaction_std "
                           f"FROM clickstream"))
def _r(c: Context):
    """Documented hashing standard applied to the interaction key (event time, item, user)."""
    return D.interactions_hash_std(c.clicks)


@register("d_hash_diff", _q(f"SELECT c_custkey, {_std(['c_custkey'])} AS hk_customer, "
                            f"{_std(['c_acctbal', 'c_mktsegment', 'c_name', 'c_nationkey'])} AS hash_diff FROM customer"))
def _r(c: Context):
    """Profile satellite key and hash diff per customer."""
    return D.customer_hash_diff(c.table("customer"))


_TIE = ["status", "latitude", "longitude", "speed_kmh", "bearing_deg", "h3_res7", "h3_res9"]


@register("d_sat_history", _q(
    f"""SELECT hk_courier_id, load_date, status, hash_diff FROM (
        SELECT *, lag(hash_diff) OVER (PARTITION BY hk_courier_id ORDER BY load_date ASC NULLS FIRST,
          {', '.join(t + ' ASC NULLS FIRST' for t in _TIE)}) AS prev
        FROM (SELECT *, {_std(['status'])} AS hash_diff FROM stg_courier_telemetry))
        WHERE prev IS NULL OR prev <> hash_diff"""))
def _r(c: Context):
    """Historised courier status satellite: a row only when the status hash diff changes."""
    h = D.historize(c.telemetry_in_order, "hk_courier_id", "load_date", ["status"], _TIE, is_dealt=True)
    return h.select("hk_courier_id", "load_date", "status", "hash_diff")


@register("d_pit", _q(
    """SELECT upper(md5(CAST(order_key AS VARCHAR))) AS hk_order_id, day AS snapshot_date,
        (SELECT max(o.o_orderdate) FROM orders o WHERE o.o_orderkey = d.order_key
           AND o.o_orderdate <= CAST(d.day + INTERVAL 1 DAY AS TIMESTAMP) - INTERVAL 1 MICROSECOND) AS header_load_date,
        max(last_ping) OVER (PARTITION BY order_key ORDER BY day) AS delivery_load_date,
        CAST(sum(n) OVER (PARTITION BY order_key ORDER BY day) AS BIGINT) AS pings_to_date
       FROM pdays d""",
    f"""pdays AS (SELECT CAST(substring(order_id, 5) AS BIGINT) AS order_key, CAST({O.load_date()} AS DATE) AS day,
        max({O.load_date()}) AS last_ping, count(*) AS n FROM telemetry WHERE order_id IS NOT NULL GROUP BY 1, 2)"""))
def _r(c: Context):
    """Point-in-time table of the order hub: as-of header and delivery load dates per ping day."""
    return D.order_pit(c.table("orders"), c.pings)


@register("d_density_last_day", _q(
    f"""SELECT h3_res7, {O.hexcell('latitude', 'longitude', 8)} AS h3_res8, event_type, count(*) AS events
        FROM stg_interactions WHERE load_date >= (SELECT max(load_date) FROM stg_interactions) - INTERVAL 1 DAY
        GROUP BY 1, 2, 3"""))
def _r(c: Context):
    """Cell density (res 7 × res 8 × event type) over the last day before the latest event."""
    return D.density_last_day(c.models["stg_interactions"])


@register("d_last5", _q(
    """SELECT user_id, string_agg(category, '|' ORDER BY rn) AS last_categories FROM (
         SELECT user_id, category, row_number() OVER (PARTITION BY user_id
                ORDER BY event_ts_ms DESC, event_id DESC) AS rn FROM cwc WHERE event_type = 'click')
       WHERE rn <= 5 GROUP BY user_id""", _CAT))
def _r(c: Context):
    """Last five clicked categories per user, newest first."""
    return D.last_clicked_categories(c.clicks_with_category)


@register("d_session_dwell", _q(
    f"""SELECT user_id, count(*) AS sessions, {O.rnd(O.emean('session_dwell'), 6)} AS session_dwell_avg FROM (
          SELECT user_id, session_no, {O.emean('dwell_time_ms')} AS session_dwell FROM (
            SELECT *, sum(start) OVER (PARTITION BY user_id ORDER BY event_ts_ms, eid
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_no FROM (
              SELECT user_id, event_ts_ms, dwell_time_ms, CAST(event_id AS BIGINT) AS eid,
                     CASE WHEN lag(event_ts_ms) OVER w IS NULL OR event_ts_ms - lag(event_ts_ms) OVER w > 1800000
                          THEN 1 ELSE 0 END AS start
              FROM click_once WINDOW w AS (PARTITION BY user_id ORDER BY event_ts_ms, CAST(event_id AS BIGINT))))
          GROUP BY user_id, session_no)
        GROUP BY user_id"""))
def _r(c: Context):
    """Sessions per user (30-minute gap) and the mean of per-session mean dwell."""
    return round_doubles(D.session_dwell(c.clicks_once), 6)


@register("d_ctr_1h", _q(
    f"""SELECT item_id, window_start, CAST(sum(CASE WHEN event_type = 'view_item' THEN 1 ELSE 0 END) AS BIGINT) AS impressions,
          CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS clicks,
          {O.rnd("CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS DOUBLE) / "
                 "nullif(sum(CASE WHEN event_type = 'view_item' THEN 1 ELSE 0 END), 0)", 6)} AS ctr
        FROM (SELECT item_id, event_type,
                make_timestamp(((event_ts_ms // 300000) * 300000 - k * 300000) * 1000) AS window_start
              FROM click_once, (SELECT unnest(range(12)) AS k))
        GROUP BY item_id, window_start"""))
def _r(c: Context):
    """Item CTR over sliding one-hour windows every five minutes."""
    return round_doubles(D.item_ctr_windows(c.clicks_once), 6)


@register("d_impression_click", _q(
    """SELECT i.event_id, i.user_id, i.item_id, i.event_ts_ms,
         CASE WHEN EXISTS (SELECT 1 FROM click_once k WHERE k.event_type = 'click' AND k.user_id = i.user_id
              AND k.item_id = i.item_id AND k.event_ts_ms >= i.event_ts_ms
              AND k.event_ts_ms - i.event_ts_ms <= 1800000) THEN 1 ELSE 0 END AS label
       FROM click_once i WHERE i.event_type = 'view_item'"""))
def _r(c: Context):
    """Impressions labelled by a click on the same item by the same user within 30 minutes."""
    return D.impression_click_labels(c.clicks_once)


@register("d_asof_training", _q(
    """SELECT i.event_id, i.user_id, i.event_ts_ms,
         (SELECT count(*) FROM click_once k WHERE k.event_type = 'click' AND k.user_id = i.user_id
            AND k.event_ts_ms < i.event_ts_ms) AS clicks_before,
         (SELECT arg_max(k.item_id, k.event_ts_ms * 1000000 + CAST(k.event_id AS BIGINT)) FROM click_once k
            WHERE k.event_type = 'click' AND k.user_id = i.user_id AND k.event_ts_ms < i.event_ts_ms) AS last_clicked_item
       FROM click_once i WHERE i.event_type = 'view_item'"""))
def _r(c: Context):
    """Training rows: per impression, the user's features as of just before it (no look-ahead)."""
    return D.asof_training_rows(c.clicks_once)


@register("d_feature_skew", _q(
    """SELECT coalesce(o.user_id, n.user_id) AS user_id, o.v AS offline_value, n.v AS online_value,
         abs(coalesce(n.v, 0) - coalesce(o.v, 0)) AS abs_diff,
         abs(coalesce(n.v, 0) - coalesce(o.v, 0)) / CAST(greatest(abs(coalesce(o.v, 0)), 1) AS DOUBLE) <= 0.05
           AS within_tolerance
       FROM (SELECT user_id, count(*) AS v FROM fct_interactions GROUP BY user_id) o
       FULL JOIN (SELECT user_id, count(*) AS v FROM clickstream GROUP BY user_id) n ON o.user_id = n.user_id"""))
def _r(c: Context):
    """Offline (deduplicated fact) vs online (realtime log) interaction counts per user, 5 % tolerance."""
    off = c.models["fct_interactions"].groupBy("user_id").agg(F.count(F.lit(1)).alias("v"))
    on = c.clicks.groupBy("user_id").agg(F.count(F.lit(1)).alias("v"))
    return D.feature_skew(off, on, "user_id", "v")


@register("d_category_affinity", _q(
    f"""SELECT user_id, category, n_30d, n_90d,
          {O.rnd('n_30d / nullif(sum(n_30d) OVER (PARTITION BY user_id), 0)', 6)} AS share_30d,
          {O.rnd('n_90d / sum(n_90d) OVER (PARTITION BY user_id)', 6)} AS share_90d
        FROM (SELECT user_id, category,
                CAST(sum(CASE WHEN event_ts_ms > (SELECT max(event_ts_ms) FROM cwc) - CAST(30 AS BIGINT) * 86400000 THEN 1 ELSE 0 END)
                     AS BIGINT) AS n_30d, count(*) AS n_90d
              FROM cwc WHERE event_ts_ms > (SELECT max(event_ts_ms) FROM cwc) - CAST(90 AS BIGINT) * 86400000
              GROUP BY user_id, category)""", _CAT))
def _r(c: Context):
    """Category share per user over the last 30 and 90 days."""
    return round_doubles(D.category_affinity(c.clicks_with_category), 6)


@register("d_ltv", _q(
    """SELECT o_custkey, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(38,2))) AS DOUBLE) AS ltv,
         min(o_orderdate) AS first_order, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey"""))
def _r(c: Context):
    """Lifetime value per customer: exact sum of order totals."""
    return D.lifetime_value(c.table("orders"))


@register("d_trending", _q(
    """SELECT item_id, count(*) AS events FROM click_once
       WHERE event_ts_ms > (SELECT max(event_ts_ms) FROM click_once) - 3600000
       GROUP BY item_id ORDER BY events DESC, item_id LIMIT 100"""))
def _r(c: Context):
    """Trending fallback: top 100 items in the hour before the latest event."""
    return D.trending_items(c.clicks_once)


@register("d_suppress", _q(
    """SELECT DISTINCT user_id, item_id FROM click_once c
       WHERE NOT EXISTS (SELECT 1 FROM click_once s WHERE s.user_id = c.user_id AND s.item_id = c.item_id
             AND s.event_type IN ('view_item', 'purchase')
             AND s.event_ts_ms > (SELECT max(event_ts_ms) FROM click_once x WHERE x.user_id = s.user_id) - 86400000)"""))
def _r(c: Context):
    """User × item candidates without items seen or bought in the user's last 24 hours."""
    return D.suppress_recent(c.clicks_once)


#: Salt of the registered test queries; a deployment passes its own secret.
TEST_SALT = "test-salt"


@register("d_masked_users", _q(
    f"""SELECT c_custkey, sha256('{TEST_SALT}' || c_name) AS c_name_masked, c_nationkey, c_mktsegment FROM customer"""))
def _r(c: Context):
    """Customers with the name replaced by a salted SHA-256."""
    return D.masked_users(c.table("customer"), TEST_SALT)


@register("d_dim_users", _q(
    f"""SELECT c.c_custkey, sha256('{TEST_SALT}' || c.c_name) AS c_name_masked, g.n_name, g.r_name, c.c_mktsegment,
          coalesce(o.n_orders, 0) AS n_orders, o.first_order
        FROM customer c
        LEFT JOIN (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) g
          ON c.c_nationkey = g.n_nationkey
        LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, min(o_orderdate) AS first_order FROM orders
                   GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey"""))
def _r(c: Context):
    """User dimension (masked name, nation, region, segment, order count, first order)."""
    return D.dim_users(c.table("customer"), c.table("nation"), c.table("region"), c.table("orders"), TEST_SALT)


@register("d_fct_daily_orders", _q(
    f"""SELECT CAST({O.load_date()} AS DATE) AS day, {O.hexcell('latitude', 'longitude', 7)} AS h3_res7,
          count(DISTINCT order_id) AS n_orders, count(*) AS n_pings, sum(speed_kmh) AS total_quantity
        FROM telemetry WHERE order_id IS NOT NULL GROUP BY 1, 2"""))
def _r(c: Context):
    """Daily delivered orders per res-7 cell."""
    return D.fct_daily_orders(c.pings)


@register("d_speed_percentiles", _q(
    f"""SELECT hk_courier_id, count(*) AS n, {O.rnd('quantile_cont(speed_kmh, 0.5)', 6)} AS p50_speed,
          {O.rnd('quantile_cont(speed_kmh, 0.9)', 6)} AS p90_speed FROM stg_courier_telemetry GROUP BY hk_courier_id"""))
def _r(c: Context):
    """Exact median and 90th percentile of speed per courier."""
    return round_doubles(D.speed_percentiles(c.models["stg_courier_telemetry"]), 6)


@register("d_travel_time", _q(
    f"""SELECT h3_res7 AS from_cell, nxt AS to_cell, count(*) AS transitions,
          {O.rnd(O.emean('(epoch_us(next_ld) - epoch_us(load_date)) / 1e6'), 6)} AS avg_seconds
        FROM (SELECT *, lead(h3_res7) OVER w AS nxt, lead(load_date) OVER w AS next_ld FROM stg_courier_telemetry
              WINDOW w AS (PARTITION BY hk_courier_id ORDER BY load_date ASC NULLS FIRST,
                {', '.join(t + ' ASC NULLS FIRST' for t in _TIE)}))
        WHERE nxt IS NOT NULL GROUP BY 1, 2"""))
def _r(c: Context):
    """Cell-to-cell transitions of consecutive courier pings and their mean duration."""
    return round_doubles(D.travel_times(c.telemetry_in_order, is_dealt=True), 6)


@register("d_psi_drift", _q(
    f"""SELECT event_type, {O.rnd('sum((c - r) * ln(c / r))', 6)} AS psi FROM (
          SELECT event_type, bin,
            greatest(ref_n / sum(ref_n) OVER (PARTITION BY event_type), {D.PSI_EPS!r}) AS r,
            greatest(cur_n / sum(cur_n) OVER (PARTITION BY event_type), {D.PSI_EPS!r}) AS c
          FROM (SELECT event_type,
                  CAST(least(floor(log10(CAST(dwell_time_ms AS DOUBLE) + 1.0) * 2.0), 9) AS INTEGER) AS bin,
                  sum(CASE WHEN event_ts_ms < mid THEN 1 ELSE 0 END) AS ref_n,
                  sum(CASE WHEN event_ts_ms < mid THEN 0 ELSE 1 END) AS cur_n
                FROM click_once, (SELECT (min(event_ts_ms) + max(event_ts_ms)) / 2 AS mid FROM click_once)
                GROUP BY 1, 2))
        GROUP BY event_type"""))
def _r(c: Context):
    """Population stability of the dwell distribution, first vs second half of the period."""
    return round_doubles(D.psi_drift(c.clicks_once), 6)


_CDC_OP = " ".join(f"WHEN o_orderstatus = '{s}' THEN '{o}'" for s, o in D.CDC_OP_BY_STATUS)


@register("d_cdc_current", _q(
    f"""SELECT user_id, display_name, event_ts_ms FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_ts_ms DESC, op ASC) AS rn FROM (
            SELECT {O.padded('USR_', 'c_custkey', 6)} AS user_id, CASE {_CDC_OP} END AS op,
                   epoch_us(o_orderdate) // 1000 + o_orderkey AS event_ts_ms,
                   concat_ws('/', c_name, o_orderpriority) AS display_name
            FROM orders JOIN customer ON o_custkey = c_custkey))
        WHERE rn = 1 AND op <> 'd'"""))
def _r(c: Context):
    """Current user rows after applying the change stream (latest per key, deletes dropped)."""
    return D.cdc_apply(D.cdc_users_from_orders(c.table("orders"), c.table("customer")))


@register("d_cell_ctr", _q(
    f"""SELECT h3_res7, {O.hexcell('latitude', 'longitude', 8)} AS h3_res8,
          CAST(sum(CASE WHEN event_type = 'view_item' THEN 1 ELSE 0 END) AS BIGINT) AS impressions,
          CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS clicks,
          {O.rnd("CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS DOUBLE) / "
                 "nullif(sum(CASE WHEN event_type = 'view_item' THEN 1 ELSE 0 END), 0)", 6)} AS ctr
        FROM stg_interactions GROUP BY 1, 2"""))
def _r(c: Context):
    """Density and click-through per res-8 cell inside each res-7 cell."""
    return round_doubles(D.cell_ctr(c.models["stg_interactions"]), 6)


_MERCH = (f"merch AS (SELECT merchant_id, {O.emean('latitude')} AS lat, {O.emean('longitude')} AS lon "
          f"FROM fct_interactions GROUP BY merchant_id)")


@register("d_bbox_candidates", _q(
    f"""SELECT merchant_id, courier_id, {O.rnd('d', 1)} AS distance_m FROM (
          SELECT m.merchant_id, p.courier_id, {O.haversine('m.lat', 'm.lon', 'p.latitude', 'p.longitude')} AS d
          FROM merch m, current_courier_positions p) WHERE d <= 1000.0""", _MERCH))
def _r(c: Context):
    """Couriers within 1 km of each merchant's mean location (neighbour-cell join, exact distance)."""
    pairs = D.within_radius(D.merchant_points(c.models["fct_interactions"]),
                            D.courier_points(c.models["current_courier_positions"]), "merchant_id", "courier_id",
                            1000.0)
    return pairs.withColumn("distance_m", F.floor(F.col("distance_m") * 10.0 + 0.5) / 10.0)


@register("d_courier_proximity", _q(
    f"""SELECT user_id, count(*) AS couriers_near, {O.rnd('min(d)', 1)} AS nearest_m FROM (
          SELECT u.user_id, {O.haversine('u.latitude', 'u.longitude', 'p.latitude', 'p.longitude')} AS d
          FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                  ORDER BY event_at DESC, hk_interaction_id ASC) AS rn FROM fct_interactions) WHERE rn = 1) u,
               current_courier_positions p) WHERE d <= 1000.0 GROUP BY user_id"""))
def _r(c: Context):
    """Per user (latest position): couriers within 1 km and the nearest distance."""
    out = D.courier_proximity(D.user_points(c.models["fct_interactions"]),
                              D.courier_points(c.models["current_courier_positions"]))
    return out.withColumn("nearest_m", F.floor(F.col("nearest_m") * 10.0 + 0.5) / 10.0)


def _sli_sql() -> str:
    rows = " UNION ALL ".join(f"SELECT '{m}' AS metric, {o!r} AS objective, {a!r} AS alert, '{k}' AS kind"
                              for m, o, a, k in D.SLI_LIMITS)
    return _q(
        f"""SELECT day, m.metric, {O.rnd('value', 6)} AS value,
              CASE WHEN kind = 'max' THEN (CASE WHEN value > alert THEN 'alert' WHEN value > objective
                                               THEN 'objective_breach' ELSE 'ok' END)
                   ELSE (CASE WHEN value < alert THEN 'alert' WHEN value < objective THEN 'objective_breach'
                              ELSE 'ok' END) END AS status
            FROM (SELECT day, 'error_rate' AS metric, errors / n AS value FROM g
                  UNION ALL SELECT day, 'purchase_rate', purchases / n FROM g
                  UNION ALL SELECT day, 'replay_rate', (n - distinct_n) / n FROM g) m
            JOIN ({rows}) l ON m.metric = l.metric""",
        f"""g AS (SELECT CAST({O.load_date()} AS DATE) AS day, count(*) AS n, count(DISTINCT event_id) AS distinct_n,
              sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS errors,
              sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS purchases FROM clickstream GROUP BY 1)""")


@register("d_sli_status", _sli_sql())
def _r(c: Context):
    """Daily service indicators (error, purchase, replay rates) against objective and alert limits."""
    m = D.sli_status(D.daily_indicators(c.clicks))
    return m.withColumn("value", F.floor(F.col("value") * 1e6 + 0.5) / 1e6)


# --- designed vault entities -------------------------------------------------------------------

from hexvault.operators import vault_ext as VX  # noqa: E402

_OID = O.padded("ORD_", "o_orderkey", 8)


@register("d_hub_item", _q(f"SELECT {O.hk('item_id')} AS hk_item_id, item_id, min({O.load_date()}) AS first_seen_at "
                           f"FROM clickstream GROUP BY 1, 2"))
def _r(c: Context):
    """Item hub from the delivered clickstream (replays collapse)."""
    return VX.hub_item(c.clicks)


@register("d_link_user_item", _q(
    f"SELECT {_std(['event_ts_ms', 'item_id', 'user_id'])} AS hk_interaction_id, {O.hk('user_id')} AS hk_user_id, "
    f"{O.hk('item_id')} AS hk_item_id, min({O.load_date()}) AS first_seen_at FROM clickstream GROUP BY 1, 2, 3"))
def _r(c: Context):
    """User–item interaction link keyed by the documented hashing standard."""
    return VX.link_user_item(c.clicks)


@register("d_hub_order", _q(f"SELECT {O.hk(_OID)} AS hk_order_id, {_OID} AS order_id, o_orderdate AS load_date "
                            f"FROM orders"))
def _r(c: Context):
    """Order hub."""
    return VX.hub_order(c.table("orders"))


@register("d_delivery_trips", _q(
    f"SELECT {O.composite('order_id', 'courier_id')} AS hk_trip_id, {O.hk('order_id')} AS hk_order_id, "
    f"{O.hk('courier_id')} AS hk_courier_id, min({O.load_date()}) AS first_ping, max({O.load_date()}) AS last_ping, "
    f"count(*) AS pings FROM telemetry WHERE order_id IS NOT NULL GROUP BY 1, 2, 3"))
def _r(c: Context):
    """Order ↔ courier delivery trips with first/last ping."""
    return VX.delivery_trips(c.pings)


@register("d_bridge", _q(
    """SELECT l.hk_interaction_id, l.hk_user_id, l.hk_merchant_id, s.event_at FROM
       (SELECT DISTINCT hk_user_id, hk_interaction_id, hk_merchant_id FROM link_v) l
       JOIN (SELECT DISTINCT hk_interaction_id, load_date AS event_at FROM sat_i_v) s
         ON l.hk_interaction_id = s.hk_interaction_id"""))
def _r(c: Context):
    """Bridge of the user → interaction → merchant path."""
    return VX.bridge_user_merchant(c.vault["link_user_merchant_interaction"],
                                   c.vault["sat_interaction_context_spatial"])


@register("d_current_status", _q(
    f"""SELECT hk_courier_id, load_date, status, hash_diff FROM (
          SELECT *, row_number() OVER (PARTITION BY hk_courier_id ORDER BY load_date DESC NULLS LAST,
            status ASC NULLS FIRST, hash_diff ASC NULLS FIRST) AS rn FROM (
            SELECT hk_courier_id, load_date, status, hash_diff FROM (
              SELECT *, lag(hash_diff) OVER (PARTITION BY hk_courier_id ORDER BY load_date ASC NULLS FIRST,
                {', '.join(t + ' ASC NULLS FIRST' for t in _TIE)}) AS prev
              FROM (SELECT *, {_std(['status'])} AS hash_diff FROM stg_courier_telemetry))
            WHERE prev IS NULL OR prev <> hash_diff))
        WHERE rn = 1"""))
def _r(c: Context):
    """Current-satellite view of the historised courier status satellite."""
    h = D.historize(c.telemetry_in_order, "hk_courier_id", "load_date", ["status"], _TIE, is_dealt=True)
    h = h.select("hk_courier_id", "load_date", "status", "hash_diff")
    return VX.current_view(h, "hk_courier_id", "load_date", ["status", "hash_diff"])


# --- model-based (iterative): rows-only checks -----------------------------------------------------

from hexvault.operators import ml as ML  # noqa: E402


@register("d_courier_clusters")
def _r(c: Context):
    """KMeans clusters of couriers by speed, activity and spatial spread (rows-only check)."""
    return ML.courier_clusters(c.models["stg_courier_telemetry"])


@register("d_als_item_factors")
def _r(c: Context):
    """Implicit-feedback ALS item factors from user × item interaction counts (rows-only check)."""
    return ML.als_factors(c.clicks_once)


@register("d_sat_merchant_location", _q(
    f"""SELECT {O.hk('merchant_id')} AS hk_merchant_id, load_day, {O.rnd('latitude', 6)} AS latitude,
          {O.rnd('longitude', 6)} AS longitude, interactions, {O.hexcell('latitude', 'longitude', 7)} AS h3_res7
        FROM (SELECT merchant_id, CAST(event_at AS DATE) AS load_day, {O.emean('latitude')} AS latitude,
                     {O.emean('longitude')} AS longitude, count(*) AS interactions
              FROM fct_interactions GROUP BY 1, 2)"""))
def _r(c: Context):
    """Daily merchant location satellite (mean interaction point and its cell)."""
    return round_doubles(VX.sat_merchant_location(c.models["fct_interactions"]), 6)


@register("d_dim_merchants", _q(
    """SELECT m.hk_merchant_id, m.merchant_id, m.first_seen_at, coalesce(f.interactions, 0) AS interactions,
         coalesce(f.purchases, 0) AS purchases, f.last_interaction_at
       FROM stg_merchants m LEFT JOIN (SELECT hk_merchant_id, count(*) AS interactions,
         CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchases,
         max(event_at) AS last_interaction_at FROM fct_interactions GROUP BY hk_merchant_id) f
       ON m.hk_merchant_id = f.hk_merchant_id"""))
def _r(c: Context):
    """Merchant dimension."""
    return VX.dim_merchants(c.models["stg_merchants"], c.models["fct_interactions"])


@register("d_dim_couriers", _q(
    """SELECT c.hk_courier_id, c.courier_id, c.first_seen_at, coalesce(t.pings, 0) AS pings,
         p.status AS current_status, p.h3_res7 AS current_h3_res7
       FROM stg_couriers c
       LEFT JOIN (SELECT hk_courier_id, count(*) AS pings FROM stg_courier_telemetry GROUP BY 1) t
         ON c.hk_courier_id = t.hk_courier_id
       LEFT JOIN current_courier_positions p ON c.hk_courier_id = p.hk_courier_id"""))
def _r(c: Context):
    """Courier dimension with the current status."""
    return VX.dim_couriers(c.models["stg_couriers"], c.models["stg_courier_telemetry"],
                           c.models["current_courier_positions"])

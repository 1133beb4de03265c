"""Designed vault extensions and feature jobs (the documented-but-unbuilt operators).

Every function is a DataFrame → DataFrame job. Where the prose leaves a choice
open, the docstring states the choice. Per-key ordered logic goes through
``sequence_features`` (skew-safe) and per-key top-k through ``top_k_per_key``
(salted two-level ranking), so a key holding a third of the rows is never
processed by a single task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexvault.functions.hashing import hash_diff, hash_key_std
from hexvault.functions.numeric import exact_mean
from hexvault.functions.spatial import SPHERE_RADIUS_M, disk, haversine_m, hex_size, hexcell, with_cells
from hexvault.operators.marts import latest_by
from hexvault.operators.sequence import sequence_features
from hexvault.sources.tables import id_number, padded_id

# Fixed values (choices stated in the docstrings below).
SESSION_GAP_S = 30 * 60
CTR_WINDOW, CTR_SLIDE = "1 hour", "5 minutes"
CLICK_ATTRIBUTION_S = 30 * 60
TOP_K_SALT = 32
PSI_EPS = 1e-6


def top_k_per_key(df: DataFrame, key: str, order: list[Column], k: int,
                  salt_buckets: int = TOP_K_SALT, salt_col: str | None = None) -> DataFrame:
    """Rows ranked 1..k per ``key`` by ``order`` (a total order), with a ``rank`` column.

    Two levels: rank inside (key, salt) and keep k, then rank the ≤ k·buckets
    survivors per key. A hot key is spread over ``salt_buckets`` tasks first.
    """
    salt = F.pmod(F.xxhash64(F.col(salt_col) if salt_col else F.struct(*df.columns)), F.lit(salt_buckets))
    first = (df.withColumn("_salt", salt)
               .withColumn("_r", F.row_number().over(Window.partitionBy(key, "_salt").orderBy(*order)))
               .filter(F.col("_r") <= k).drop("_r", "_salt"))
    return (first.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
                 .filter(F.col("rank") <= k))


# --- D01, D02, D03: hashing standard and historised satellites ---------------------------

def interactions_hash_std(clicks: DataFrame) -> DataFrame:
    """Standard interaction key over (event_ts_ms, item_id, user_id) – the event time enters
    as its epoch-millisecond text so every engine renders it identically."""
    return clicks.select("event_id", hash_key_std(["event_ts_ms", "item_id", "user_id"]).alias("hk_interaction_std"))


def customer_hash_diff(customer: DataFrame) -> DataFrame:
    """Profile satellite key and hash diff of a customer (user profile surrogate)."""
    return customer.select(
        "c_custkey", hash_key_std(["c_custkey"]).alias("hk_customer"),
        hash_diff(["c_acctbal", "c_mktsegment", "c_name", "c_nationkey"]).alias("hash_diff"))


def historize(sat: DataFrame, key: str, ts: str, attributes: list[str], tie_break: list[str],
              is_dealt: bool = False) -> DataFrame:
    """Insert-only-on-change satellite: keep a row when its hash diff differs from the
    previous row of the same key (by ``ts`` then ``tie_break``); the first row is kept.
    ``is_dealt``: the rows come from ``dealt`` by key and ``ts``."""
    with_hd = sat.withColumn("hash_diff", hash_diff(attributes))
    seq = sequence_features(with_hd, key, [ts, *tie_break], lag=["hash_diff"], is_dealt=is_dealt)
    return seq.filter(F.col("prev_hash_diff").isNull() | (F.col("prev_hash_diff") != F.col("hash_diff"))) \
              .drop("prev_hash_diff")


# --- D05, D06: order hub and point-in-time table -------------------------------------------

def order_pit(orders: DataFrame, pings: DataFrame, seed: DataFrame | None = None) -> DataFrame:
    """Point-in-time rows for the order hub, one per (order, day with a delivery ping).

    Columns: ``header_load_date`` – as-of load date of the order header satellite
    (order date, if on or before the snapshot day end), ``delivery_load_date`` –
    latest ping of that order up to the snapshot, ``pings_to_date`` – pings so far.
    Built with one ordered pass per order (header row + ping-days), skew-safe. ``seed``
    (``order_key, ts, ping_ts, n``) is what earlier days left of each order, when
    ``pings`` hold later days only.
    """
    o = orders.select(F.col("o_orderkey").alias("order_key"),
                      F.col("o_orderdate").cast("timestamp_ntz").alias("ts"),
                      F.lit(0).alias("kind"), F.col("o_orderdate").cast("timestamp_ntz").alias("header_ts"),
                      F.lit(None).cast("timestamp_ntz").alias("ping_ts"), F.lit(0).alias("n"))
    days = (pings.filter(F.col("order_id").isNotNull())
            .select(id_number("order_id", "ORD_").alias("order_key"),
                    F.to_date("event_time").alias("day"), F.col("event_time"))
            .groupBy("order_key", "day").agg(F.max("event_time").alias("last_ping"), F.count(F.lit(1)).alias("n")))
    snap_end = F.date_add("day", 1).cast("timestamp_ntz")
    d = days.select("order_key", (snap_end - F.expr("INTERVAL 1 MICROSECOND")).alias("ts"), F.lit(1).alias("kind"),
                    F.lit(None).cast("timestamp_ntz").alias("header_ts"), F.col("last_ping").alias("ping_ts"), "n")
    rows = o.unionByName(d)
    if seed is not None:
        rows = rows.unionByName(seed.select("order_key", "ts", F.lit(0).alias("kind"),
                                            F.lit(None).cast("timestamp_ntz").alias("header_ts"), "ping_ts", "n"))
    seq = sequence_features(rows, "order_key", ["ts", "kind"], ffill=["header_ts", "ping_ts"], cumsum=["n"])
    return seq.filter(F.col("kind") == 1).select(
        *(["order_key"] if seed is not None else []),
        F.upper(F.md5(F.col("order_key").cast("string"))).alias("hk_order_id"),
        F.to_date("ts").alias("snapshot_date"), F.col("ffill_header_ts").alias("header_load_date"),
        F.col("ffill_ping_ts").alias("delivery_load_date"), F.col("cum_n").alias("pings_to_date"))


# --- D09, D42: spatial density ---------------------------------------------------------------

def density_last_day(sat: DataFrame) -> DataFrame:
    """Counts by (res 7, res 8, event_type) over the day before the latest event (as of the data)."""
    asof = sat.agg(F.max("load_date")).scalar()  # scalar subquery, evaluated once
    recent = sat.filter(F.col("load_date") >= asof - F.expr("INTERVAL 1 DAY"))
    cells = with_cells(recent, "latitude", "longitude", {8: "h3_res8"})
    return cells.groupBy("h3_res7", "h3_res8", "event_type").agg(F.count(F.lit(1)).alias("events"))


def cell_ctr(sat: DataFrame) -> DataFrame:
    """Impressions, clicks and CTR per res-8 cell inside each res-7 cell."""
    cells = with_cells(sat, "latitude", "longitude", {8: "h3_res8"})
    imp = F.sum(F.when(F.col("event_type") == "view_item", 1).otherwise(0))
    clk = F.sum(F.when(F.col("event_type") == "click", 1).otherwise(0))
    out = cells.groupBy("h3_res7", "h3_res8").agg(imp.cast("bigint").alias("impressions"),
                                                   clk.cast("bigint").alias("clicks"))
    return out.withColumn("ctr", F.col("clicks") / F.nullif(F.col("impressions"), F.lit(0)).cast("double"))


# --- D14, D15, D16: user and item features ------------------------------------------------------

def last_clicked_categories(clicks_with_category: DataFrame, k: int = 5) -> DataFrame:
    """The k most recent clicked categories per user, newest first, as ``a|b|c`` text."""
    clicked = clicks_with_category.filter(F.col("event_type") == "click")
    order = [F.col("event_ts_ms").desc(), F.col("event_id").desc()]
    top = top_k_per_key(clicked, "user_id", order, k, salt_col="event_id")
    return top.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("rank", "category"))).alias("_l")) \
              .select("user_id", F.concat_ws("|", F.col("_l.category")).alias("last_categories"))


def session_dwell(clicks: DataFrame, gap_s: int = SESSION_GAP_S) -> DataFrame:
    """Sessions split by a gap above ``gap_s`` (30 min, the prose leaves it open).

    Per user: number of sessions and the mean over sessions of the session's mean dwell.
    """
    ev = clicks.select("user_id", "event_id", "event_ts_ms", "dwell_time_ms")
    ev = ev.withColumn("_eid", F.col("event_id").cast("bigint"))
    s1 = sequence_features(ev, "user_id", ["event_ts_ms", "_eid"], lag=["event_ts_ms"])
    flag = (F.col("prev_event_ts_ms").isNull()
            | (F.col("event_ts_ms") - F.col("prev_event_ts_ms") > gap_s * 1000)).cast("int")
    s2 = sequence_features(s1.withColumn("start", flag).drop("prev_event_ts_ms"), "user_id",
                           ["event_ts_ms", "_eid"], cumsum=["start"])
    sessions = s2.groupBy("user_id", F.col("cum_start").alias("session_no")).agg(
        exact_mean("dwell_time_ms").alias("session_dwell"))
    return sessions.groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions"),
                                           exact_mean("session_dwell").alias("session_dwell_avg"))


def item_ctr_windows(clicks: DataFrame) -> DataFrame:
    """Sliding 1-hour windows every 5 minutes: impressions, clicks and CTR per item."""
    ts = F.timestamp_millis("event_ts_ms")
    w = clicks.select("item_id", "event_type", F.window(ts, CTR_WINDOW, CTR_SLIDE).alias("w"))
    out = w.groupBy("item_id", F.col("w.start").cast("timestamp_ntz").alias("window_start")).agg(
        F.sum(F.when(F.col("event_type") == "view_item", 1).otherwise(0)).cast("bigint").alias("impressions"),
        F.sum(F.when(F.col("event_type") == "click", 1).otherwise(0)).cast("bigint").alias("clicks"))
    return out.withColumn("ctr", F.col("clicks") / F.nullif(F.col("impressions"), F.lit(0)).cast("double"))


# --- D18, D20, D21: labels, as-of training rows, skew ------------------------------------------

def _events_kinds(clicks: DataFrame) -> DataFrame:
    return clicks.select("event_id", "user_id", "item_id", "event_type", "event_ts_ms",
                         F.col("event_id").cast("bigint").alias("_eid"))


def impression_click_labels(clicks: DataFrame, within_s: int = CLICK_ATTRIBUTION_S) -> DataFrame:
    """Label each impression (view) 1 when the same user clicks the same item within
    ``within_s`` seconds at or after it (recommendation id = user + item).

    Computed as a reverse as-of fill of the next click time per (user, item): no
    impression × click pairs are formed, so a hot pair stays linear.
    """
    ev = _events_kinds(clicks).filter(F.col("event_type").isin("view_item", "click"))
    ev = ev.withColumn("rec_id", F.concat_ws("/", "user_id", "item_id")) \
           .withColumn("_neg_ts", -F.col("event_ts_ms")) \
           .withColumn("_kind", F.when(F.col("event_type") == "click", 0).otherwise(1)) \
           .withColumn("_click_ts", F.when(F.col("event_type") == "click", F.col("event_ts_ms")))
    seq = sequence_features(ev, "rec_id", ["_neg_ts", "_kind", "_eid"], ffill=["_click_ts"])
    imp = seq.filter(F.col("event_type") == "view_item")
    label = (F.col("ffill__click_ts").isNotNull()
             & (F.col("ffill__click_ts") - F.col("event_ts_ms") <= within_s * 1000)).cast("int")
    return imp.select("event_id", "user_id", "item_id", "event_ts_ms", label.alias("label"))


def asof_training_rows(clicks: DataFrame) -> DataFrame:
    """Per impression: the user's click count and last clicked item strictly before it."""
    ev = _events_kinds(clicks).filter(F.col("event_type").isin("view_item", "click"))
    ev = ev.withColumn("_kind", F.when(F.col("event_type") == "view_item", 0).otherwise(1)) \
           .withColumn("is_click", (F.col("event_type") == "click").cast("int")) \
           .withColumn("clicked_item", F.when(F.col("event_type") == "click", F.col("item_id")))
    seq = sequence_features(ev, "user_id", ["event_ts_ms", "_kind", "_eid"], ffill=["clicked_item"],
                            cumsum=["is_click"])
    return seq.filter(F.col("event_type") == "view_item").select(
        "event_id", "user_id", "event_ts_ms", F.col("cum_is_click").alias("clicks_before"),
        F.col("ffill_clicked_item").alias("last_clicked_item"))


def feature_skew(offline: DataFrame, online: DataFrame, key: str, value: str,
                 tolerance: float = 0.05) -> DataFrame:
    """Full outer join of two feature tables; relative difference against a tolerance."""
    o = offline.select(key, F.col(value).alias("offline_value"))
    n = online.select(key, F.col(value).alias("online_value"))
    j = o.join(n, key, "full")
    diff = F.abs(F.coalesce("online_value", F.lit(0)) - F.coalesce("offline_value", F.lit(0)))
    rel = diff / F.greatest(F.abs(F.coalesce("offline_value", F.lit(0))), F.lit(1)).cast("double")
    return j.select(key, "offline_value", "online_value", diff.alias("abs_diff"),
                    (rel <= tolerance).alias("within_tolerance"))


# --- D22, D23, D26, D28: affinity, value, trending, suppression --------------------------------

def category_affinity(events: DataFrame) -> DataFrame:
    """Interactions per user and category in the 30 and 90 days before the latest event,
    with each category's share of the user's total in that window."""
    asof = events.agg(F.max("event_ts_ms")).scalar()
    day = 86400 * 1000
    e = events.filter(F.col("event_ts_ms") > asof - 90 * day)
    in30 = (F.col("event_ts_ms") > asof - 30 * day).cast("int")
    g = e.groupBy("user_id", "category").agg(F.sum(in30).cast("bigint").alias("n_30d"),
                                             F.count(F.lit(1)).alias("n_90d"))
    w = Window.partitionBy("user_id")  # rows per user = categories, not events
    return g.select("user_id", "category", "n_30d", "n_90d",
                    (F.col("n_30d") / F.nullif(F.sum("n_30d").over(w), F.lit(0))).alias("share_30d"),
                    (F.col("n_90d") / F.sum("n_90d").over(w)).alias("share_90d"))


def lifetime_value(orders: DataFrame) -> DataFrame:
    """Per customer: orders, lifetime value (exact sum of order totals), first/last order."""
    return orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.col("o_totalprice").cast("decimal(38,2)")).cast("double").alias("ltv"),
        F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"))


def trending_items(events: DataFrame, k: int = 100) -> DataFrame:
    """Top-k items by events in the hour before the latest event (ties: item id)."""
    asof = events.agg(F.max("event_ts_ms")).scalar()
    recent = events.filter(F.col("event_ts_ms") > asof - 3600 * 1000)
    return (recent.groupBy("item_id").agg(F.count(F.lit(1)).alias("events"))
                  .orderBy(F.col("events").desc(), F.col("item_id")).limit(k))


def suppress_recent(events: DataFrame, hours: int = 24) -> DataFrame:
    """Distinct (user, item) candidates minus items the user viewed or bought within
    ``hours`` of the user's own latest event (time-bounded anti join)."""
    cand = events.select("user_id", "item_id").distinct()
    last = events.groupBy("user_id").agg(F.max("event_ts_ms").alias("_last"))
    seen = (events.filter(F.col("event_type").isin("view_item", "purchase"))
                  .join(last, "user_id")
                  .filter(F.col("event_ts_ms") > F.col("_last") - hours * 3600 * 1000)
                  .select("user_id", "item_id").distinct())
    return cand.join(seen, ["user_id", "item_id"], "left_anti")


# --- D30, D34: masking and Kimball dimensions ---------------------------------------------------

def mask(c, salt: str) -> Column:
    """Salted SHA-256 of a PII value (hex)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sha2(F.concat(F.lit(salt), col.cast("string")), 256)


def masked_users(customer: DataFrame, salt: str) -> DataFrame:
    return customer.select("c_custkey", mask("c_name", salt).alias("c_name_masked"), "c_nationkey",
                           "c_mktsegment")


def dim_users(customer: DataFrame, nation: DataFrame, region: DataFrame, orders: DataFrame,
              salt: str) -> DataFrame:
    """User dimension: masked name, nation, region, segment, order count, first order."""
    o = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"),
                                        F.min("o_orderdate").alias("first_order"))
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")
    return (customer.join(geo, customer.c_nationkey == geo.n_nationkey, "left")
                    .join(o, customer.c_custkey == o.o_custkey, "left")
                    .select("c_custkey", mask("c_name", salt).alias("c_name_masked"), "n_name", "r_name",
                            "c_mktsegment", F.coalesce("n_orders", F.lit(0)).alias("n_orders"), "first_order"))


def fct_daily_orders(pings: DataFrame) -> DataFrame:
    """Per day and res-7 cell: distinct orders delivered, pings, total quantity."""
    cells = with_cells(pings.filter(F.col("order_id").isNotNull()), "latitude", "longitude", {7: "h3_res7"})
    return cells.groupBy(F.to_date("event_time").alias("day"), "h3_res7").agg(
        F.countDistinct("order_id").alias("n_orders"), F.count(F.lit(1)).alias("n_pings"),
        F.sum("speed_kmh").alias("total_quantity"))


# --- D35, D36, D38: courier analytics and drift --------------------------------------------------

def speed_percentiles(telemetry: DataFrame) -> DataFrame:
    """Exact p50/p90 speed per courier (interpolated), from counts per speed and running sums.

    Equal speeds combine before the shuffle; a courier's distinct speeds stream through
    a sorted window instead of sitting in one buffer.
    """
    counted = telemetry.groupBy("hk_courier_id", "speed_kmh").agg(F.count(F.lit(1)).alias("c"))
    totals = counted.groupBy("hk_courier_id").agg(
        F.sum("c").alias("n"), F.sum(F.when(F.col("speed_kmh").isNotNull(), F.col("c"))).alias("known"))
    up_to = Window.partitionBy("hk_courier_id").orderBy("speed_kmh").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (counted.filter("speed_kmh IS NOT NULL").withColumn("hi", F.sum("c").over(up_to))
              .withColumn("lo", F.col("hi") - F.col("c")).join(totals, "hk_courier_id", "right"))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("lo") <= rank) & (rank < F.col("hi")), F.col("speed_kmh")))

    def quantile(p: float) -> Column:
        place = F.lit(p) * (F.col("known") - 1)
        low, high = at(F.floor(place)), at(F.ceil(place))
        return low + (high - low) * F.max(place - F.floor(place))

    return ranked.groupBy("hk_courier_id").agg(F.max("n").alias("n"), quantile(0.5).alias("p50_speed"),
                                               quantile(0.9).alias("p90_speed"))


def travel_times(telemetry: DataFrame, is_dealt: bool = False) -> DataFrame:
    """Cell-to-next-cell transitions per courier: count and mean seconds between pings.
    ``is_dealt``: the pings come from ``dealt`` by courier and load date."""
    order = ["load_date", "status", "latitude", "longitude", "speed_kmh", "bearing_deg", "h3_res7", "h3_res9"]
    seq = sequence_features(telemetry.withColumn("_t", F.unix_micros(F.col("load_date").cast("timestamp"))),
                            "hk_courier_id", order, lead=["h3_res7", "_t"], is_dealt=is_dealt)
    moves = seq.filter(F.col("next_h3_res7").isNotNull())
    return moves.groupBy(F.col("h3_res7").alias("from_cell"), F.col("next_h3_res7").alias("to_cell")).agg(
        F.count(F.lit(1)).alias("transitions"),
        exact_mean((F.col("next__t") - F.col("_t")) / F.lit(1e6)).alias("avg_seconds"))


def dwell_bin(c) -> Column:
    """Ten fixed bins of log10(dwell + 1) in half-decade steps (the prose leaves binning open)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.least(F.floor(F.log10(col.cast("double") + 1.0) * 2.0), F.lit(9)).cast("int")


def psi_drift(events: DataFrame) -> DataFrame:
    """Population stability index of the dwell distribution per event type: the first
    half of the time range (reference) against the second half (current)."""
    mid = events.agg((F.min("event_ts_ms") + F.max("event_ts_ms")) / 2).scalar()
    e = events.withColumn("period", F.when(F.col("event_ts_ms") < mid, "ref").otherwise("cur")) \
         .withColumn("bin", dwell_bin("dwell_time_ms"))
    counts = e.groupBy("event_type", "bin").agg(
        F.sum((F.col("period") == "ref").cast("int")).alias("ref_n"),
        F.sum((F.col("period") == "cur").cast("int")).alias("cur_n"))
    w = Window.partitionBy("event_type")  # ≤ 10 rows per event type
    p = counts.select("event_type", "bin",
                      F.greatest(F.col("ref_n") / F.sum("ref_n").over(w), F.lit(PSI_EPS)).alias("r"),
                      F.greatest(F.col("cur_n") / F.sum("cur_n").over(w), F.lit(PSI_EPS)).alias("c"))
    return p.groupBy("event_type").agg(F.sum((F.col("c") - F.col("r")) * F.log(F.col("c") / F.col("r"))).alias("psi"))


# --- D41: CDC apply ------------------------------------------------------------------------------

CDC_OP_BY_STATUS = [("O", "c"), ("F", "u"), ("P", "d")]


def cdc_users_from_orders(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """User change events derived from orders (adapter): op c/u/d by order status,
    event time = order date + order key ms (unique per user), name from the customer."""
    op = None
    for s, o in CDC_OP_BY_STATUS:
        op = F.when(F.col("o_orderstatus") == s, o) if op is None else op.when(F.col("o_orderstatus") == s, o)
    ts = F.unix_millis(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey")
    j = orders.join(customer, orders.o_custkey == customer.c_custkey)
    return j.select(padded_id("USR_", F.col("c_custkey"), 6).alias("user_id"),
                    op.alias("op"), ts.alias("event_ts_ms"),
                    F.concat_ws("/", "c_name", "o_orderpriority").alias("display_name"))


def cdc_apply(changes: DataFrame, key: str = "user_id") -> DataFrame:
    """Current rows: latest change per key by event time (ties: op), deletes removed."""
    latest = latest_by(changes.withColumn("_t", F.timestamp_millis("event_ts_ms")), key, "_t", ["op"],
                       [key, "op", "event_ts_ms", "display_name"])
    return latest.filter(F.col("op") != "d").select(key, "display_name", "event_ts_ms")


# --- D43, D44: neighbour-cell range joins ----------------------------------------------------------

#: Widest ring of cells that a radius search may open.
MAX_RING = 40

def within_radius(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  radius_m: float) -> DataFrame:
    """Pairs at most ``radius_m`` apart: an equi-join on the res-7 cells around each left point, then the distance.

    The projection stretches a distance by at most 1 / cos(latitude), two points in one
    cell are at most two cell sizes apart, and cells at grid distance k have centres at
    least 1.5 * k sizes apart; so cells up to ``(radius / cos + 2 size) / (1.5 size)``
    cover the circle. Points near the date line also search from the other side of it.
    Raises where that ring is wider than ``MAX_RING`` (close to a pole, or a huge radius).
    Both sides need ``lat``, ``lon``, ``cell``.
    """
    size, degrees = hex_size(7), math.degrees(radius_m / SPHERE_RADIUS_M)
    stretch = 1 / F.cos(F.radians(F.least(F.abs("lat") + degrees, F.lit(89.99))))
    ring = F.floor((F.lit(radius_m) * stretch * 1.01 + 2 * size) / (1.5 * size)).cast("int")
    ring = F.when(ring <= MAX_RING, ring).otherwise(
        F.raise_error(F.lit("within_radius: the radius is too wide for res-7 cells at this latitude")))
    other_side = F.when(F.abs("lon") + F.lit(degrees) * stretch * 1.01 > 180,
                        hexcell(F.col("lat"), F.col("lon") - 360 * F.signum("lon"), 7))
    centres = F.filter(F.array(F.col("cell"), other_side), lambda c: c.isNotNull())
    l = (left.select(F.col(left_key), F.col("lat").alias("l_lat"), F.col("lon").alias("l_lon"),
                     ring.alias("_ring"), F.explode(centres).alias("_centre"))
         .select(left_key, "l_lat", "l_lon", F.explode(disk(F.col("_centre"), F.col("_ring"))).alias("cell")))
    r = right.select(F.col(right_key), F.col("lat").alias("r_lat"), F.col("lon").alias("r_lon"), "cell")
    j = l.join(r, "cell")
    d = haversine_m("l_lat", "l_lon", "r_lat", "r_lon")
    return j.select(left_key, right_key, d.alias("distance_m")).filter(F.col("distance_m") <= radius_m)


def merchant_points(interactions: DataFrame) -> DataFrame:
    """Mean interaction point of each merchant and its res-7 cell."""
    m = interactions.groupBy("merchant_id").agg(exact_mean("latitude").alias("lat"),
                                                exact_mean("longitude").alias("lon"))
    return with_cells(m, "lat", "lon", {7: "cell"})


def courier_points(positions: DataFrame) -> DataFrame:
    return positions.select("courier_id", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"),
                            F.col("h3_res7").alias("cell"))


def user_points(fact: DataFrame) -> DataFrame:
    """Each user's latest interaction point (skew-safe latest-by aggregate)."""
    latest = latest_by(fact, "user_id", "event_at", ["hk_interaction_id"],
                       ["user_id", "latitude", "longitude", "h3_res7"])
    return latest.select("user_id", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"),
                         F.col("h3_res7").alias("cell"))


def courier_proximity(users: DataFrame, couriers: DataFrame, radius_m: float = 1000.0) -> DataFrame:
    """Per user: couriers within the radius and the nearest distance (users without any are absent)."""
    pairs = within_radius(users, couriers, "user_id", "courier_id", radius_m)
    return pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("couriers_near"),
                                        F.min("distance_m").alias("nearest_m"))


# --- D45: service indicators ----------------------------------------------------------------------

# Indicator limits (objective, alert limit); "max" = value must stay below.
SLI_LIMITS = [("error_rate", 0.15, 0.25, "max"), ("purchase_rate", 0.15, 0.10, "min"),
              ("replay_rate", 0.05, 0.15, "max")]


def daily_indicators(clicks: DataFrame) -> DataFrame:
    """Per day: error rate (contract-violating event types), purchase rate, replay rate."""
    day = F.to_date(F.timestamp_millis("event_ts_ms").cast("timestamp_ntz"))
    g = clicks.groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("distinct_n"),
        F.sum((F.col("event_type") == "error").cast("int")).alias("errors"),
        F.sum((F.col("event_type") == "purchase").cast("int")).alias("purchases"))
    return g.select("day", F.expr("stack(3, 'error_rate', errors / n, 'purchase_rate', purchases / n, "
                                  "'replay_rate', (n - distinct_n) / n) AS (metric, value)"))


def sli_status(metrics: DataFrame) -> DataFrame:
    """Join metric rows with the (3-row, fixed) limits table: ok / objective_breach / alert."""
    spark = metrics.sparkSession
    limits = spark.createDataFrame(SLI_LIMITS, "metric string, objective double, alert double, kind string")
    j = metrics.join(F.broadcast(limits), "metric")
    v, o, a = F.col("value"), F.col("objective"), F.col("alert")
    status = (F.when(F.col("kind") == "max", F.when(v > a, "alert").when(v > o, "objective_breach").otherwise("ok"))
               .otherwise(F.when(v < a, "alert").when(v < o, "objective_breach").otherwise("ok")))
    return j.select("day", "metric", "value", status.alias("status"))


# --- D27, D29, D31: re-rank diversity, boost and stock filter, crypto-shredding ---------------------

MAX_CATEGORY_RUN = 3
NEW_ITEM_DAYS = 7
NEW_ITEM_BOOST = 0.2


def rerank_diversity(candidates: DataFrame, key: str = "user_id", max_run: int = MAX_CATEGORY_RUN,
                     limit: int = 200) -> DataFrame:
    """Greedy re-rank per user: highest score first, but never more than ``max_run``
    consecutive items of one category while another category is available.

    The feature is a re-ranked top list: the ``limit`` best candidates of a user are
    chosen first (salted two-level ranking), so the per-user ``applyInPandas`` group
    that follows is bounded whatever the data.
    """
    import pandas as pd
    candidates = top_k_per_key(candidates, key, [F.desc("score"), F.asc("item_id")], limit).drop("rank")

    def greedy(pdf: pd.DataFrame) -> pd.DataFrame:
        pool = pdf.sort_values(["score", "item_id"], ascending=[False, True]).to_dict("records")
        out, run_cat, run = [], None, 0
        while pool:
            pick = 0
            if run >= max_run:
                alt = [i for i, r in enumerate(pool) if r["category"] != run_cat]
                pick = alt[0] if alt else 0
            r = pool.pop(pick)
            run = run + 1 if r["category"] == run_cat else 1
            run_cat = r["category"]
            out.append({**r, "position": len(out) + 1})
        return pd.DataFrame(out, columns=[*pdf.columns, "position"])

    from pyspark.sql import types as T
    schema = T.StructType(list(candidates.schema.fields) + [T.StructField("position", T.IntegerType())])
    return candidates.groupBy(key).applyInPandas(greedy, schema)


def boost_and_filter(scored: DataFrame, items_first_seen: DataFrame, in_stock: DataFrame,
                     as_of: Column) -> DataFrame:
    """Keep in-stock items (semi join) and boost items first seen within 7 days of ``as_of``."""
    kept = scored.join(in_stock.select("item_id").distinct(), "item_id", "left_semi")
    j = kept.join(items_first_seen.select("item_id", "first_seen_at"), "item_id", "left")
    new = F.col("first_seen_at") >= as_of - F.expr(f"INTERVAL {NEW_ITEM_DAYS} DAYS")
    return j.withColumn("boosted_score", F.when(new, F.col("score") * (1 + NEW_ITEM_BOOST)).otherwise(F.col("score")))


def subject_keys(subjects: DataFrame, key: str, path: str) -> DataFrame:
    """Per-subject 256-bit data keys, written to ``path`` (which must be new) and read back.

    Keys are bytes of the operating system's generator, drawn in the tasks. Only stored
    keys are returned: drawn again, they would differ, and what was encrypted under the
    first ones could not be read.
    """
    names = subjects.select(key).distinct()

    def draw(batches):
        import secrets

        import pyarrow as pa
        for batch in batches:
            keys = pa.array([secrets.token_bytes(32) for _ in range(batch.num_rows)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), keys], [key, "data_key"])

    kind = names.schema[key].dataType.simpleString()
    names.mapInArrow(draw, f"`{key}` {kind}, data_key binary").write.parquet(path)
    return subjects.sparkSession.read.parquet(path)


def shred_encrypt(df: DataFrame, keys: DataFrame, key: str, pii: list[str]) -> DataFrame:
    """Replace PII columns by AES-GCM ciphertext under the subject's key."""
    j = df.join(keys, key)
    return j.select(*[c for c in df.columns if c not in pii],
                    *[F.aes_encrypt(F.col(c).cast("string"), F.col("data_key"), F.lit("GCM")).alias(f"{c}_enc")
                      for c in pii])


def shred_decrypt(enc: DataFrame, keys: DataFrame, key: str, pii: list[str]) -> DataFrame:
    """Readable view: subjects whose key was erased (row deleted) read back as null."""
    j = enc.join(keys, key, "left")
    return j.select(*[c for c in enc.columns if not c.endswith("_enc")],
                    *[F.try_aes_decrypt(F.col(f"{c}_enc"), F.col("data_key"), F.lit("GCM")).cast("string").alias(c)
                      for c in pii])

"""Declared schemas of every source, sink and model (nothing is inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, I, B = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType(), T.BinaryType()
TS = T.TimestampNTZType()


def _struct(*fields, nullable=True) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t in fields])


CLICKSTREAM = _struct(("event_id", S), ("user_id", S), ("item_id", S), ("merchant_id", S),
                      ("event_type", S), ("device_type", S), ("dwell_time_ms", L),
                      ("referrer_page", S), ("latitude", D), ("longitude", D), ("event_ts_ms", L))
TELEMETRY = _struct(("telemetry_id", S), ("courier_id", S), ("order_id", S), ("latitude", D),
                    ("longitude", D), ("speed_kmh", D), ("bearing_deg", I), ("status", S),
                    ("event_ts_ms", L))

HUB_USER = _struct(("hk_user_id", S), ("user_id", S), ("load_date", TS), ("record_source", S))
HUB_MERCHANT = _struct(("hk_merchant_id", S), ("merchant_id", S), ("load_date", TS), ("record_source", S))
HUB_COURIER = _struct(("hk_courier_id", S), ("courier_id", S), ("load_date", TS), ("record_source", S))
LINK_INTERACTION = _struct(("hk_interaction_id", S), ("hk_user_id", S), ("hk_merchant_id", S),
                           ("load_date", TS), ("record_source", S))
SAT_INTERACTION = _struct(("hk_interaction_id", S), ("load_date", TS), ("event_type", S),
                          ("device_type", S), ("dwell_time_ms", L), ("referrer_page", S),
                          ("latitude", D), ("longitude", D), ("h3_res7", L), ("h3_res9", L),
                          ("geom_wkb", B), ("record_source", S))
SAT_COURIER = _struct(("hk_courier_id", S), ("load_date", TS), ("latitude", D), ("longitude", D),
                      ("speed_kmh", D), ("bearing_deg", I), ("status", S), ("h3_res7", L),
                      ("h3_res9", L), ("geom_wkb", B), ("record_source", S))
COURIER_LIVE = _struct(("hk_courier_id", S), ("courier_id", S), ("latitude", D), ("longitude", D),
                       ("speed_kmh", D), ("bearing_deg", I), ("status", S), ("h3_res7", L),
                       ("h3_res9", L), ("event_ts_ms", L))
CLICKSTREAM_LOG = _struct(("hk_interaction_id", S), ("user_id", S), ("merchant_id", S),
                          ("event_type", S), ("device_type", S), ("dwell_time_ms", L),
                          ("latitude", D), ("longitude", D), ("h3_res7", L), ("h3_res9", L),
                          ("event_ts_ms", L))

VAULT_TABLES = {
    "hub_user": HUB_USER,
    "hub_merchant": HUB_MERCHANT,
    "hub_courier": HUB_COURIER,
    "link_user_merchant_interaction": LINK_INTERACTION,
    "sat_interaction_context_spatial": SAT_INTERACTION,
    "sat_courier_telemetry_spatial": SAT_COURIER,
}
STREAM_TABLES = {
    "courier_telemetry_live": COURIER_LIVE,
    "clickstream_realtime_log": CLICKSTREAM_LOG,
}

# Accepted domains declared by the model tests.
EVENT_TYPES = ["view_item", "click", "add_to_cart", "purchase"]
COURIER_STATUSES = ["to_merchant", "at_merchant", "delivering", "idle"]
RESOLUTIONS = [7, 9]
RECORD_SOURCES = {"clickstream": "events.clickstream", "telemetry": "events.telemetry"}

# Allowed declared type names per source column (length suffix ignored), as the
# schema-conformance tests state them.
_STR = ["VARCHAR", "CHAR", "STRING"]
_TS = ["DATETIME", "TIMESTAMP"]
SOURCE_TYPE_RULES = {
    "hub_user": {"hk_user_id": _STR, "user_id": _STR, "load_date": _TS, "record_source": _STR},
    "hub_merchant": {"hk_merchant_id": _STR, "merchant_id": _STR, "load_date": _TS,
                     "record_source": _STR},
    "hub_courier": {"hk_courier_id": _STR, "courier_id": _STR, "load_date": _TS,
                    "record_source": _STR},
    "link_user_merchant_interaction": {"hk_interaction_id": _STR, "hk_user_id": _STR,
                                       "hk_merchant_id": _STR, "load_date": _TS,
                                       "record_source": _STR},
    "sat_interaction_context_spatial": {
        "hk_interaction_id": _STR, "load_date": _TS, "event_type": _STR, "device_type": _STR,
        "dwell_time_ms": ["BIGINT"], "referrer_page": _STR, "latitude": ["DOUBLE"],
        "longitude": ["DOUBLE"], "h3_res7": ["BIGINT"], "h3_res9": ["BIGINT"],
        "record_source": _STR},
    "sat_courier_telemetry_spatial": {
        "hk_courier_id": _STR, "load_date": _TS, "latitude": ["DOUBLE"], "longitude": ["DOUBLE"],
        "speed_kmh": ["DOUBLE"], "bearing_deg": ["INT", "INTEGER"], "status": _STR,
        "h3_res7": ["BIGINT"], "h3_res9": ["BIGINT"], "record_source": _STR},
}


def sql_type_name(dtype: T.DataType) -> str:
    """SQL-style upper-case type name of a Spark type (for schema conformance)."""
    mapping = {
        T.StringType: "STRING", T.LongType: "BIGINT", T.IntegerType: "INT", T.DoubleType: "DOUBLE",
        T.FloatType: "FLOAT", T.TimestampNTZType: "TIMESTAMP", T.TimestampType: "TIMESTAMP",
        T.DateType: "DATE", T.BinaryType: "VARBINARY", T.BooleanType: "BOOLEAN",
        T.ShortType: "SMALLINT", T.ByteType: "TINYINT",
    }
    for cls, name in mapping.items():
        if isinstance(dtype, cls):
            return name
    return dtype.simpleString().upper().split("(")[0]

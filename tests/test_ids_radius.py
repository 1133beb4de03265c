"""Business keys wider than their padding, and the radius join against a plain count."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

import harness
from hexvault.functions.spatial import hexcell
from hexvault.operators import features as D
from hexvault.operators.vault_ext import hub_order
from hexvault.sources import tables


def test_wide_ids_stay_apart(spark):
    df = spark.createDataFrame([(1000,), (10000,), (123456,), (1234567,), (100000001,), (1000000010,)], "n long")
    for prefix, width in (("DRV_", 4), ("USR_", 6), ("ORD_", 8)):
        got = df.select("n", tables.padded_id(prefix, F.col("n"), width).alias("id"))
        rows = got.select("n", "id", tables.id_number("id", prefix).alias("back")).collect()
        assert len({r.id for r in rows}) == len(rows)
        assert all(r.back == r.n and len(r.id) >= len(prefix) + width for r in rows)


def test_wide_keys_in_events_and_orders(spark):
    item = "l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long, l_quantity double, l_returnflag string, " \
           "l_linestatus string, l_shipdate date"
    import datetime as dt
    rows = [(o, 1, s, 5, 1.0, "N", "O", dt.date(2024, 1, 1)) for o, s in ((123456789, 1000), (12345678, 10000))]
    got = tables.telemetry_from_lineitem(spark.createDataFrame(rows, item)).collect()
    assert {r.courier_id for r in got} == {"DRV_1000", "DRV_10000"}
    assert {r.order_id for r in got} == {"ORD_123456789", "ORD_12345678"}
    orders = spark.createDataFrame([(123456789, dt.date(2024, 1, 1)), (12345678, dt.date(2024, 1, 1))],
                                   "o_orderkey long, o_orderdate date")
    assert hub_order(orders).select("hk_order_id").distinct().count() == 2


def test_oracle_pads_the_same_way(spark):
    from hexvault.oracle import padded
    con = harness.duckdb.connect()
    for n in (7, 1000, 10000, 123456789):
        want = spark.range(1).select(tables.padded_id("DRV_", F.lit(n), 4)).first()[0]
        assert con.execute(f"SELECT {padded('DRV_', str(n), 4)}").fetchone()[0] == want


def metres(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371000.0 * math.asin(math.sqrt(h))


@pytest.mark.parametrize("lat,lon,radius", [(10.0, 106.0, 5000.0), (70.0, 20.0, 1000.0), (75.0, -30.0, 1000.0),
                                            (-60.0, 179.99, 3000.0), (0.0, -180.0, 2000.0), (10.0, 106.0, 1000.0)])
def test_radius_join_finds_every_pair(spark, lat, lon, radius):
    rnd = random.Random(round(lat + radius))
    span = 2 * radius / 111_000
    wrap = lambda x: (x + 180) % 360 - 180
    points = [(i, lat + rnd.uniform(-span, span),
               wrap(lon + rnd.uniform(-span, span) / math.cos(math.radians(lat)))) for i in range(300)]
    frame = spark.createDataFrame(points, "k int, lat double, lon double").withColumn("cell", hexcell("lat", "lon", 7))
    left, right = frame.withColumnRenamed("k", "a"), frame.withColumnRenamed("k", "b")
    got = {(r.a, r.b) for r in D.within_radius(left, right, "a", "b", radius).collect()}
    want = {(p[0], q[0]) for p in points for q in points if metres(p[1:], q[1:]) <= radius}
    assert got == want


def test_radius_join_raises_where_the_ring_is_not_proven(spark):
    frame = spark.createDataFrame([(1, 89.9, 0.0)], "k int, lat double, lon double").withColumn(
        "cell", hexcell("lat", "lon", 7))
    with pytest.raises(Exception, match="too wide"):
        D.within_radius(frame.withColumnRenamed("k", "a"), frame.withColumnRenamed("k", "b"), "a", "b", 5000.0).collect()


def test_percentiles_are_exact(spark):
    rows = [("a", float(x)) for x in (5, 1, 1, 9, 3)] + [("b", 2.0), ("c", None)]
    got = {r["hk_courier_id"]: (r["n"], r["p50_speed"], r["p90_speed"]) for r in D.speed_percentiles(
        spark.createDataFrame(rows, "hk_courier_id string, speed_kmh double")).collect()}
    assert got == {"a": (5, 3.0, pytest.approx(7.4)), "b": (1, 2.0, 2.0), "c": (1, None, None)}

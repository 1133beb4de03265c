"""Column functions against independent Python computations."""

from __future__ import annotations

import hashlib
import math
import random
import struct

from pyspark.sql import functions as F

from hexvault.functions import hashing as H
from hexvault.functions import spatial as SP


def test_hash_key_vectors(spark):
    df = spark.createDataFrame([("u1",), ("  u1\t",), ("\x1fu2　",), ("",), (None,)], "v string")
    got = [r[0] for r in df.select(H.hash_key("v")).collect()]
    exp = [hashlib.md5(v.strip().encode()).hexdigest().upper() if v is not None else None
           for v in ["u1", "  u1\t", "\x1fu2　", "", None]]
    assert got == exp
    assert got[0] == "E4774CDDA0793F86414E8B9140BB6DB4"


def test_py_strip_matches_python(spark):
    rnd = random.Random(7)
    alphabet = list(H.PY_WHITESPACE) + list("ab;-é​")
    values = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 8))) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(H.py_strip("v")).collect()]
    assert got == [v.strip() for v in values]


def test_composite_key_rules(spark):
    rows = [("u1", "m1", "5"), ("u1", "", "5"), (None, "m1", "5"), (" ", "m1", "5"), (" u1 ", "m1", "5")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    got = [r[0] for r in df.select(H.composite_key("a", "b", "c")).collect()]

    def ref(a, b, c):
        if not a or not b or not c:
            return None
        return hashlib.md5(f"{a.strip()};{b.strip()};{c.strip()}".encode()).hexdigest().upper()
    assert got == [ref(*r) for r in rows]


def test_hash_key_std(spark):
    df = spark.createDataFrame([(" ab ", None, 3)], "user_id string, item_id string, n int")
    got = df.select(H.hash_key_std(["user_id", "n", "item_id"])).first()[0]
    token = "\x1f".join(["^^NULL^^", "3", "AB"])  # item_id, n, user_id
    assert got == hashlib.md5(token.encode()).hexdigest()


def test_hexcell_staged_and_python_twin_agree(spark):
    rnd = random.Random(1)
    pts = [(rnd.uniform(-60, 60), rnd.uniform(-179, 179)) for _ in range(500)] + [(None, 1.0)]
    df = spark.createDataFrame(pts, "lat double, lon double")
    direct = df.select(SP.hexcell("lat", "lon", 7).alias("a"), SP.hexcell("lat", "lon", 9).alias("b"))
    staged = SP.with_cells(df, "lat", "lon", {7: "a", 9: "b"}).select("a", "b")
    assert direct.collect() == staged.collect()
    for (lat, lon), r in zip(pts[:50], direct.collect()[:50]):
        assert SP.neighbour_cells_py(lat, lon, 7)[0] == r["a"]
    assert direct.collect()[-1]["a"] is None


def test_neighbours_are_equidistant(spark):
    df = spark.createDataFrame([(10.775, 106.7)], "lat double, lon double")
    cell = df.select(SP.hexcell("lat", "lon", 7).alias("c")).first()["c"]
    ring = df.select(SP.neighbours(F.lit(cell)).alias("n")).first()["n"]
    assert ring == SP.neighbour_cells_py(10.775, 106.7, 7)
    assert len(set(ring)) == 7 and ring[0] == cell


def test_point_wkb_bytes(spark):
    df = spark.createDataFrame([(10.775, 106.7), (None, 1.0)], "lat double, lon double")
    got = [r[0] for r in df.select(SP.point_wkb("lat", "lon")).collect()]
    assert got[0] == struct.pack("<BIdd", 1, 1, 106.7, 10.775)
    assert got[1] is None


def test_haversine_and_rounding(spark):
    df = spark.createDataFrame([(10.775, 106.7, 10.81, 106.74)], "a double, b double, c double, d double")
    d = df.select(SP.haversine_m("a", "b", "c", "d")).first()[0]
    p1, p2 = math.radians(10.775), math.radians(10.81)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(0.04) / 2) ** 2
    assert abs(d - 2 * 6371000 * math.asin(math.sqrt(a))) < 1e-6
    r = spark.createDataFrame([(1.005,), (0.285,), (2.5,)], "x double").select(SP.round_half_up("x", 2)).collect()
    assert [x[0] for x in r] == [math.floor(1.005 * 100 + 0.5) / 100, math.floor(0.285 * 100 + 0.5) / 100, 2.5]


def test_h3_bit_fields(spark):
    # 0x8928308280fffff: mode 1, resolution 9, base cell 20 (public H3 example id)
    cell = int("8928308280fffff", 16)
    df = spark.createDataFrame([(cell,)], "c long")
    r = df.select(SP.h3_mode("c").alias("m"), SP.h3_resolution("c").alias("r"),
                  SP.h3_base_cell("c").alias("b"), SP.h3_is_valid_cell("c").alias("v")).first()
    assert (r["m"], r["r"], r["b"], r["v"]) == (1, 9, 20, True)
    bad = spark.createDataFrame([(609777061401198591,)], "c long").select(SP.h3_is_valid_cell("c")).first()[0]
    assert bad is False


def test_cell_guards(spark):
    import pytest
    with pytest.raises(ValueError):
        SP.hex_size(16)
    assert abs(SP.hex_size(8) - 1409.0 / math.sqrt(7)) < 1e-9
    if not SP.h3_available():
        with pytest.raises(RuntimeError):
            SP.h3_cell("lat", "lon", 9)
    df = spark.createDataFrame([(SP.neighbour_cells_py(10.775, 106.7, 7)[0],)], "c long")
    r = df.select(SP.cell_resolution("c").alias("res"), SP.cell_q("c").alias("q"), SP.cell_r("c").alias("r")).first()
    assert r["res"] == 7 and abs(r["q"]) < 2 ** 27 and abs(r["r"]) < 2 ** 27

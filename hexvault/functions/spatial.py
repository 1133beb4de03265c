"""Spatial column functions: hexagon cells, neighbours, great-circle distance, WKB.

``hexcell`` is an equal-area hexagon lattice written in plain column expressions so
it stays inside whole-stage codegen and has an exact DuckDB twin. It is **not**
H3-compatible: ids are ``res·2^56 + (q+2^27)·2^28 + (r+2^27)`` over axial
coordinates of a pointy-top lattice on a cylindrical equal-area projection. Cell
sizes are chosen to match the mean H3 cell area at resolutions 7 and 9. True H3
(``h3_cell``) is available only when the optional ``h3`` package is importable.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Projection radius (m), hexagon size (centre-to-corner, m) per
# resolution, id packing offsets, neighbour offsets, great-circle radius (m).
EARTH_RADIUS_EQUAL_AREA = 6371007.2
HEX_SIZE_M = {7: 1409.0, 9: 201.35}
AXIS_OFFSET = 2 ** 27
AXIS_BITS = 28
RES_SHIFT = 56
NEIGHBOUR_OFFSETS = [(0, 0), (1, 0), (-1, 0), (0, 1), (0, -1), (1, -1), (-1, 1)]
SPHERE_RADIUS_M = 6371000.0
SQRT3_OVER_3 = math.sqrt(3.0) / 3.0


def hex_size(res: int) -> float:
    """Hexagon size in metres: fixed for 7 and 9, else scaled by sqrt(7) per level from 7."""
    if not isinstance(res, int) or not 0 <= res <= 15:
        raise ValueError(f"Unsupported cell resolution: {res!r}")
    if res in HEX_SIZE_M:
        return HEX_SIZE_M[res]
    return HEX_SIZE_M[7] * (7.0 ** ((7 - res) / 2.0))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _axial(lat: Column, lon: Column, res: int) -> tuple[Column, Column]:
    s = hex_size(res)
    x = F.lit(EARTH_RADIUS_EQUAL_AREA) * F.radians(lon)
    y = F.lit(EARTH_RADIUS_EQUAL_AREA) * F.sin(F.radians(lat))
    qf = (F.lit(SQRT3_OVER_3) * x - y / F.lit(3.0)) / F.lit(s)
    rf = (F.lit(2.0 / 3.0) * y) / F.lit(s)
    return qf, rf


def _cube_round(qf: Column, rf: Column) -> tuple[Column, Column]:
    sf = -qf - rf
    rq = F.floor(qf + F.lit(0.5))
    rr = F.floor(rf + F.lit(0.5))
    rs = F.floor(sf + F.lit(0.5))
    dq = F.abs(rq - qf)
    dr = F.abs(rr - rf)
    ds = F.abs(rs - sf)
    q = F.when((dq > dr) & (dq > ds), -rs - rr).otherwise(rq)
    r = F.when((dq > dr) & (dq > ds), rr).when(dr > ds, -rq - rs).otherwise(rr)
    return q.cast("bigint"), r.cast("bigint")


def pack_cell(res: int, q: Column, r: Column) -> Column:
    return (F.lit(res).cast("bigint") * F.lit(2 ** RES_SHIFT)
            + (q + F.lit(AXIS_OFFSET)) * F.lit(2 ** AXIS_BITS)
            + (r + F.lit(AXIS_OFFSET)))


def hexcell(lat, lon, res: int) -> Column:
    """Cell id (bigint) of a point; null when either coordinate is null."""
    lat, lon = _col(lat), _col(lon)
    q, r = _cube_round(*_axial(lat, lon, res))
    cell = pack_cell(res, q, r)
    return F.when(lat.isNull() | lon.isNull(), F.lit(None).cast("bigint")).otherwise(cell)


def _d(x: float) -> str:
    """A double literal in Spark SQL text (a bare decimal would parse as DECIMAL)."""
    return f"{x!r}D"


def with_cells(df, lat: str, lon: str, outputs: dict[int, str]):
    """Add one cell-id column per resolution (``{res: name}``) in staged projections.

    Same arithmetic as ``hexcell`` but every intermediate (projection, axial
    coordinates, rounding deltas) is its own column, so each is evaluated once per
    row. The optimizer keeps non-trivial columns that are referenced more than once
    in separate projections, all inside one whole-stage-codegen span. Each stage is
    one SQL-expression projection (one planner call instead of one per operator).
    """
    base = [f"`{c}`" for c in df.columns]
    R = _d(EARTH_RADIUS_EQUAL_AREA)
    st = df.selectExpr("*", f"{R} * radians(`{lon}`) AS _hx_x", f"{R} * sin(radians(`{lat}`)) AS _hx_y")
    e = []
    for res in outputs:
        sz = _d(hex_size(res))
        e += [f"({_d(SQRT3_OVER_3)} * _hx_x - _hx_y / 3.0D) / {sz} AS _qf{res}",
              f"({_d(2.0 / 3.0)} * _hx_y) / {sz} AS _rf{res}"]
    st = st.selectExpr("*", *e)
    e = []
    for r in outputs:
        e += [f"-_qf{r} - _rf{r} AS _sf{r}", f"floor(_qf{r} + 0.5D) AS _rq{r}",
              f"floor(_rf{r} + 0.5D) AS _rr{r}"]
    st = st.selectExpr("*", *e)
    st = st.selectExpr("*", *[f"floor(_sf{r} + 0.5D) AS _rs{r}" for r in outputs])
    e = []
    for r in outputs:
        e += [f"abs(_rq{r} - _qf{r}) AS _dq{r}", f"abs(_rr{r} - _rf{r}) AS _dr{r}",
              f"abs(_rs{r} - _sf{r}) AS _ds{r}"]
    st = st.selectExpr("*", *e)
    e = []
    for r, name in outputs.items():
        win = f"(_dq{r} > _dr{r} AND _dq{r} > _ds{r})"
        q = f"CAST(CASE WHEN {win} THEN -_rs{r} - _rr{r} ELSE _rq{r} END AS BIGINT)"
        rr = (f"CAST(CASE WHEN {win} THEN _rr{r} WHEN _dr{r} > _ds{r} THEN -_rq{r} - _rs{r} "
              f"ELSE _rr{r} END AS BIGINT)")
        packed = (f"CAST({r} AS BIGINT) * {2 ** RES_SHIFT}L + ({q} + {AXIS_OFFSET}L) * {2 ** AXIS_BITS}L"
                  f" + ({rr} + {AXIS_OFFSET}L)")
        e.append(f"CASE WHEN `{lat}` IS NULL OR `{lon}` IS NULL THEN CAST(NULL AS BIGINT) "
                 f"ELSE {packed} END AS `{name}`")
    return st.selectExpr(*base, *e)


def cell_resolution(cell) -> Column:
    return F.shiftright(_col(cell), RES_SHIFT)


def cell_q(cell) -> Column:
    mask = (1 << AXIS_BITS) - 1
    return (F.shiftright(_col(cell), AXIS_BITS).bitwiseAND(F.lit(mask)) - F.lit(AXIS_OFFSET))


def cell_r(cell) -> Column:
    mask = (1 << AXIS_BITS) - 1
    return _col(cell).bitwiseAND(F.lit(mask)) - F.lit(AXIS_OFFSET)


def neighbours(cell) -> Column:
    """``grid_disk(cell, 1)``: the cell itself and its six neighbours, as array<bigint>."""
    cell = _col(cell)
    res = cell_resolution(cell)
    q, r = cell_q(cell), cell_r(cell)
    items = []
    for dq, dr in NEIGHBOUR_OFFSETS:
        items.append(res * F.lit(2 ** RES_SHIFT)
                     + (q + F.lit(dq) + F.lit(AXIS_OFFSET)) * F.lit(2 ** AXIS_BITS)
                     + (r + F.lit(dr) + F.lit(AXIS_OFFSET)))
    return F.when(cell.isNull(), F.lit(None)).otherwise(F.array(*items))


def disk(cell, ring) -> Column:
    """``grid_disk(cell, ring)`` for a column of ring widths, as array<bigint>.

    A step of (dq, dr) adds ``dq * 2**AXIS_BITS + dr`` to the packed id.
    """
    cell, ring = _col(cell), _col(ring)
    return F.flatten(F.transform(F.sequence(-ring, ring), lambda dq: F.transform(
        F.sequence(F.greatest(-ring, -dq - ring), F.least(ring, -dq + ring)),
        lambda dr: cell + dq.cast("bigint") * F.lit(2 ** AXIS_BITS) + dr)))


def neighbour_cells_py(lat: float, lon: float, res: int = 7) -> list[int]:
    """Driver-side twin of ``neighbours(hexcell(lat, lon, res))`` for one request point.

    Used only for the request parameters of a single serving call (7 integers).
    """
    s = hex_size(res)
    x = EARTH_RADIUS_EQUAL_AREA * math.radians(lon)
    y = EARTH_RADIUS_EQUAL_AREA * math.sin(math.radians(lat))
    qf = (SQRT3_OVER_3 * x - y / 3.0) / s
    rf = (2.0 / 3.0 * y) / s
    sf = -qf - rf
    rq, rr, rs = math.floor(qf + 0.5), math.floor(rf + 0.5), math.floor(sf + 0.5)
    dq, dr, ds = abs(rq - qf), abs(rr - rf), abs(rs - sf)
    if dq > dr and dq > ds:
        rq = -rs - rr
    elif dr > ds:
        rr = -rq - rs
    return [res * 2 ** RES_SHIFT + (rq + a + AXIS_OFFSET) * 2 ** AXIS_BITS + (rr + b + AXIS_OFFSET)
            for a, b in NEIGHBOUR_OFFSETS]


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres on a sphere of radius 6,371,000 m."""
    lat1, lon1, lat2, lon2 = map(_col, (lat1, lon1, lat2, lon2))
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dphi = F.radians(lat2 - lat1)
    dlmb = F.radians(lon2 - lon1)
    a = F.pow(F.sin(dphi / 2.0), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2.0), 2)
    return F.lit(2.0 * SPHERE_RADIUS_M) * F.asin(F.sqrt(a))


def round_half_up(c, digits: int) -> Column:
    """``floor(x·10^d + 0.5) / 10^d`` – identical in Spark and DuckDB (``round`` is not)."""
    scale = float(10 ** digits)
    return F.floor(_col(c) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def hex_lower(c) -> Column:
    """Lower-case hex text of a bigint cell; null stays null."""
    return F.lower(F.hex(_col(c)))


_WKB_DTYPE = np.dtype([("order", "u1"), ("kind", "<u4"), ("x", "<f8"), ("y", "<f8")])


@F.pandas_udf(T.BinaryType())
def _point_wkb(lat: pd.Series, lon: pd.Series) -> pd.Series:
    buf = np.zeros(len(lat), dtype=_WKB_DTYPE)
    buf["order"] = 1
    buf["kind"] = 1
    buf["x"] = lon.to_numpy(dtype="float64", na_value=np.nan)
    buf["y"] = lat.to_numpy(dtype="float64", na_value=np.nan)
    raw = buf.tobytes()
    out = [raw[i * 21:(i + 1) * 21] for i in range(len(buf))]
    mask = (lat.isna() | lon.isna()).to_numpy()
    return pd.Series([None if m else b for b, m in zip(out, mask)], dtype=object)


def point_wkb(lat, lon) -> Column:
    """Little-endian WKB Point(x=lon, y=lat), 21 bytes; null when either input is null.

    Spark has no double → IEEE-bytes expression, so this is an Arrow-batched UDF.
    """
    return _point_wkb(_col(lat), _col(lon))


# --- H3 bit fields (plain expressions over 64-bit H3 ids) ---------------------------

def h3_mode(cell) -> Column:
    return F.shiftright(_col(cell), 59).bitwiseAND(F.lit(15))


def h3_resolution(cell) -> Column:
    return F.shiftright(_col(cell), 52).bitwiseAND(F.lit(15))


def h3_base_cell(cell) -> Column:
    return F.shiftright(_col(cell), 45).bitwiseAND(F.lit(127))


def h3_digit(cell, i: int) -> Column:
    return F.shiftright(_col(cell), 45 - 3 * i).bitwiseAND(F.lit(7))


def h3_is_valid_cell(cell) -> Column:
    """Structural validity: mode 1, reserved bits 0, base cell < 122, digits ≤ res not 7, rest 7."""
    c = _col(cell)
    res = h3_resolution(c)
    ok = (h3_mode(c) == 1) & (F.shiftright(c, 56).bitwiseAND(F.lit(7)) == 0) & (h3_base_cell(c) < 122)
    ok = ok & (c > 0)
    for i in range(1, 16):
        d = h3_digit(c, i)
        ok = ok & F.when(F.lit(i) <= res, d != 7).otherwise(d == 7)
    return ok


try:  # optional true H3 (not installed in the build image)
    import h3 as _h3  # type: ignore
except Exception:  # pragma: no cover - import guard
    _h3 = None


def h3_available() -> bool:
    return _h3 is not None


def h3_cell(lat, lon, res: int) -> Column:
    """True H3 ``latlng_to_cell`` as a signed bigint; needs the optional ``h3`` package."""
    if _h3 is None:
        raise RuntimeError("The optional 'h3' package is not installed; use hexcell()")

    @F.pandas_udf(T.LongType())
    def _cell(la: pd.Series, lo: pd.Series) -> pd.Series:
        def one(a, b):
            if pd.isna(a) or pd.isna(b):
                return None
            try:
                v = int(_h3.latlng_to_cell(float(a), float(b), res), 16)
                return v - (1 << 64) if v >= (1 << 63) else v
            except Exception:
                return None
        return pd.Series([one(a, b) for a, b in zip(la, lo)], dtype="Int64")

    return _cell(_col(lat), _col(lon))

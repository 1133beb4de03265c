"""The five scalar functions registered by name for SQL users.

``py_md5``, ``py_composite_hk``, ``py_h3_res7`` and ``py_h3_res9`` are SQL
user-defined functions (``CREATE TEMPORARY FUNCTION … RETURN <expression>``):
their bodies are plain expressions, so they stay inside the JVM and codegen.
``py_point_to_wkb`` needs IEEE-754 bytes and is the Arrow-batched function from
``spatial.point_wkb``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from hexvault.functions.hashing import PY_WHITESPACE
from hexvault.functions.spatial import (AXIS_BITS, AXIS_OFFSET, EARTH_RADIUS_EQUAL_AREA, RES_SHIFT,
                                        SQRT3_OVER_3, _point_wkb, hex_size)


def _ws_literal() -> str:
    return "concat(" + ", ".join(f"char({ord(c)})" for c in PY_WHITESPACE) + ")"


def _cell_sql(res: int) -> str:
    """The ``hexcell`` arithmetic as one Spark SQL expression over ``lat``/``lon``
    (double literals carry the ``D`` suffix so nothing is computed in DECIMAL)."""
    s, R = f"{hex_size(res)!r}D", f"{EARTH_RADIUS_EQUAL_AREA!r}D"
    x, y = f"({R} * radians(lon))", f"({R} * sin(radians(lat)))"
    qf = f"(({SQRT3_OVER_3!r}D * {x} - {y} / 3.0D) / {s})"
    rf = f"(({2.0 / 3.0!r}D * {y}) / {s})"
    sf = f"(-{qf} - {rf})"
    rq, rr, rs = f"floor({qf} + 0.5D)", f"floor({rf} + 0.5D)", f"floor({sf} + 0.5D)"
    dq, dr, ds = f"abs({rq} - {qf})", f"abs({rr} - {rf})", f"abs({rs} - {sf})"
    q = f"CAST(CASE WHEN {dq} > {dr} AND {dq} > {ds} THEN -{rs} - {rr} ELSE {rq} END AS BIGINT)"
    r = f"CAST(CASE WHEN {dq} > {dr} AND {dq} > {ds} THEN {rr} WHEN {dr} > {ds} THEN -{rq} - {rs} ELSE {rr} END AS BIGINT)"
    packed = f"CAST({res} AS BIGINT) * {2 ** RES_SHIFT}L + ({q} + {AXIS_OFFSET}L) * {2 ** AXIS_BITS}L + ({r} + {AXIS_OFFSET}L)"
    return f"CASE WHEN lat IS NULL OR lon IS NULL THEN CAST(NULL AS BIGINT) ELSE {packed} END"


def register_sql_functions(spark: SparkSession) -> list[str]:
    ws = _ws_literal()
    stmts = {
        "py_md5": f"CREATE OR REPLACE TEMPORARY FUNCTION py_md5(val STRING) RETURNS STRING "
                  f"RETURN upper(md5(btrim(val, {ws})))",
        "py_composite_hk": (
            "CREATE OR REPLACE TEMPORARY FUNCTION py_composite_hk(a STRING, b STRING, c STRING) RETURNS STRING "
            "RETURN CASE WHEN a IS NULL OR a = '' OR b IS NULL OR b = '' OR c IS NULL OR c = '' THEN NULL "
            f"ELSE upper(md5(concat_ws(';', btrim(a, {ws}), btrim(b, {ws}), btrim(c, {ws})))) END"),
    }
    for res in (7, 9):
        stmts[f"py_h3_res{res}"] = (f"CREATE OR REPLACE TEMPORARY FUNCTION py_h3_res{res}(lat DOUBLE, lon DOUBLE) "
                                    f"RETURNS BIGINT RETURN {_cell_sql(res)}")
    for stmt in stmts.values():
        spark.sql(stmt)
    spark.udf.register("py_point_to_wkb", _point_wkb)
    return [*stmts, "py_point_to_wkb"]

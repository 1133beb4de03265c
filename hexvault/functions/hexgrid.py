"""Nested hexagon cells: an aperture-7 hierarchy over the finest lattice of ``spatial.hexcell``.

Axial coordinates (q, r) are the integer ``q + r·ζ`` with ζ a sixth root of one. The
multiples of ``β = 2 + ζ`` (norm 7) are the centres of the next coarser lattice, and
each integer is one of the seven ``β·p + u`` with u zero or a unit: p is its parent and u,
as a number from 0 to 6, its digit. So a cell has exactly one parent and seven children at
every level, a point's cell at any resolution follows from its finest id alone, and sums
over children are the sum of the parent. All functions are plain column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexvault.functions.spatial import AXIS_BITS, AXIS_OFFSET, RES_SHIFT, cell_q, cell_r, cell_resolution, with_cells

#: Resolution of the lattice that points fall into.
FINEST = 9


def _digit_of(q: int, r: int) -> int:
    """Residue of a cell: β and its multiples have residue 0."""
    return (q + 5 * r) % 7


#: Offset of a child from its parent's centre, by digit.
UNITS = {_digit_of(q, r): (q, r) for q, r in ((0, 0), (1, 0), (0, 1), (-1, 1), (-1, 0), (0, -1), (1, -1))}


def _packed(res: Column, q: Column, r: Column) -> Column:
    return (F.shiftleft(res.cast("bigint"), RES_SHIFT)
            + (q + F.lit(AXIS_OFFSET)) * F.lit(2 ** AXIS_BITS) + (r + F.lit(AXIS_OFFSET)))


def cell_digit(cell: Column) -> Column:
    """Which of its parent's seven children a cell is (0 is the centre)."""
    return F.pmod(cell_q(cell) + 5 * cell_r(cell), F.lit(7)).cast("int")


def _unit(digit: Column, axis: int) -> Column:
    return F.element_at(F.array(*[F.lit(UNITS[d][axis]).cast("bigint") for d in range(7)]), digit + 1)


def _centre(q: Column, r: Column, digit: Column) -> tuple[Column, Column]:
    """Axial coordinates of the parent. Division by β is multiplication by its conjugate 3 - ζ over its
    norm; it leaves no remainder once the unit of the digit is taken off."""
    q, r = q - _unit(digit, 0), r - _unit(digit, 1)
    return ((3 * q + r) / 7).cast("bigint"), ((2 * r - q) / 7).cast("bigint")


def cell_parent(cell: Column | str) -> Column:
    """The cell one level coarser that a cell lies in; null for null."""
    cell = F.col(cell) if isinstance(cell, str) else cell
    return _packed(cell_resolution(cell) - 1, *_centre(cell_q(cell), cell_r(cell), cell_digit(cell)))


def with_parents(df: DataFrame, cell: str, outputs: dict[int, str], res: int = FINEST) -> DataFrame:
    """``df`` with the cells of coarser resolutions, ``{res: name}``, that the cells of ``res`` lie in.

    Every level is a projection of its own, so each coordinate is computed once a row.
    """
    if not outputs or not all(0 <= k < res for k in outputs):
        raise ValueError(f"Unsupported nested resolutions: {sorted(outputs)!r}")
    st = df.withColumns({"_hq": cell_q(cell), "_hr": cell_r(cell)})
    q, r = F.col("_hq"), F.col("_hr")
    for level in range(res - 1, min(outputs) - 1, -1):
        st = st.withColumn("_hd", F.pmod(q + 5 * r, F.lit(7)).cast("int"))
        up = _centre(q, r, F.col("_hd"))
        st = st.withColumns({"_hq": up[0], "_hr": up[1]})
        if level in outputs:
            st = st.withColumn(outputs[level], _packed(F.lit(level), q, r))
    return st.drop("_hq", "_hr", "_hd")


def cell_children(cell: Column | str) -> Column:
    """The seven cells one level finer, by digit."""
    cell = F.col(cell) if isinstance(cell, str) else cell
    q, r, res = cell_q(cell), cell_r(cell), cell_resolution(cell) + 1
    return F.when(cell.isNotNull(), F.array(*[
        _packed(res, 2 * q - r + UNITS[d][0], q + 3 * r + UNITS[d][1]) for d in range(7)]))


def with_nested(df: DataFrame, lat: str, lon: str, outputs: dict[int, str]) -> DataFrame:
    """``df`` with the nested cells of a point, ``{res: name}``, up to ``FINEST``."""
    finest = outputs.get(FINEST, "_finest")
    st = with_cells(df, lat, lon, {FINEST: finest})
    coarse = {k: n for k, n in outputs.items() if k != FINEST}
    st = with_parents(st, finest, coarse) if coarse else st
    return st if FINEST in outputs else st.drop(finest)


# --- DuckDB twin ---------------------------------------------------------------------------

def sql_parent(cell: str) -> str:
    """Twin of ``cell_parent`` by one level, by division with remainder instead of tables of units."""
    mask, half = (1 << AXIS_BITS) - 1, AXIS_OFFSET
    q, r = f"((({cell}) >> {AXIS_BITS}) & {mask}) - {half}", f"(({cell}) & {mask}) - {half}"
    # u by digit: the offsets of 0, 1, 2, ... 6
    unit = lambda axis: "[" + ", ".join(str(UNITS[d][axis]) for d in range(7)) + "]"
    return (f"(SELECT CASE WHEN q IS NULL THEN NULL ELSE ((res - 1) << {RES_SHIFT}) "
            f"+ ((3 * (q - {unit(0)}[d + 1]) + (r - {unit(1)}[d + 1])) // 7 + {half}) * {2 ** AXIS_BITS} "
            f"+ ((2 * (r - {unit(1)}[d + 1]) - (q - {unit(0)}[d + 1])) // 7 + {half}) END FROM "
            f"(SELECT q, r, res, (((q + 5 * r) % 7) + 7) % 7 AS d FROM "
            f"(SELECT {q} AS q, {r} AS r, ({cell}) >> {RES_SHIFT} AS res)))")

"""Hexagonal cells: bit operations on H3 indexes, and a planar grid with the same interface.

The planar grid lies on longitude and latitude; a cell's circumradius at a
resolution is ``BASE_DEGREES / 7 ** (resolution / 2)``, which is near the sizes
of H3. A cell is written as 15 hexadecimal digits: resolution, then two axial
coordinates of 28 bits. Every function is a column expression.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_DEGREES = 10.0
_OFFSET = 1 << 27
_ROOT3 = math.sqrt(3.0)


def radius(resolution: int) -> float:
    return BASE_DEGREES / 7 ** (resolution / 2)


# H3 indexes ------------------------------------------------------------------------------


def h3_parent(cell: Column, resolution: int) -> Column:
    """The H3 index (a long) of an ancestor: resolution set, finer digits all 7."""
    cleared = cell.bitwiseAND(F.lit(~(15 << 52)))
    return cleared.bitwiseOR(F.lit(resolution << 52)).bitwiseOR(F.lit((1 << 3 * (15 - resolution)) - 1))


def h3_resolution(cell: Column) -> Column:
    return F.shiftright(cell, 52).bitwiseAND(F.lit(15)).cast("int")


def h3_base_cell(cell: Column) -> Column:
    return F.shiftright(cell, 45).bitwiseAND(F.lit(127)).cast("int")


def h3_text(cell: Column) -> Column:
    return F.lower(F.hex(cell))


# the planar grid -------------------------------------------------------------------------


def _pack(q: Column, r: Column, resolution: int) -> Column:
    number = F.shiftleft((q + _OFFSET).cast("long"), 28).bitwiseOR((r + _OFFSET).cast("long")).bitwiseOR(F.lit(resolution << 56))
    return F.lpad(F.lower(F.hex(number)), 15, "0")


def _number(cell: Column) -> Column:
    return F.conv(cell, 16, 10).cast("long")


def axial(cell: Column) -> tuple[Column, Column]:
    number = _number(cell)
    mask = F.lit((1 << 28) - 1)
    return F.shiftright(number, 28).bitwiseAND(mask) - _OFFSET, number.bitwiseAND(mask) - _OFFSET


def resolution_of(cell: Column) -> Column:
    return F.shiftright(_number(cell), 56).cast("int")


def cell_of(lon: Column, lat: Column, resolution: int) -> Column:
    """The cell that holds a point."""
    size = radius(resolution)
    q = (lon * F.lit(_ROOT3 / 3) - lat / F.lit(3.0)) / F.lit(size)
    r = lat * F.lit(2.0) / F.lit(3.0) / F.lit(size)
    near = lambda x: F.floor(x + F.lit(0.5))
    nq, nr, ns = near(q), near(r), near(-q - r)
    # the order of the sum decides about points between two cells: the oracle's SQL has this one
    dq, dr, ds = F.abs(nq - q), F.abs(nr - r), F.abs(ns + q + r)
    by_q, by_r = (dq > dr) & (dq > ds), (dr > ds)
    return _pack(F.when(by_q, -nr - ns).otherwise(nq), F.when(~by_q & by_r, -nq - ns).otherwise(nr), resolution)


def center(cell: Column, resolution: int) -> tuple[Column, Column]:
    """Longitude and latitude of the cell's centre."""
    q, r = axial(cell)
    size = radius(resolution)
    return F.lit(size * _ROOT3) * (q + r / F.lit(2.0)), F.lit(size * 1.5) * r


def parent(cell: Column, resolution: int, coarser: int) -> Column:
    """The coarser cell that holds the cell's centre."""
    return cell_of(*center(cell, resolution), coarser)


def disk(cell: Column, k: int, resolution: int) -> Column:
    """Array of (cell, ring) within k steps, the cell itself in ring 0."""
    q, r = axial(cell)
    steps = [(a, b) for a in range(-k, k + 1) for b in range(-k, k + 1) if abs(a + b) <= k]
    return F.array(*(F.struct(_pack(q + a, r + b, resolution).alias("cell"), F.lit((abs(a) + abs(b) + abs(a + b)) // 2).alias("ring")) for a, b in steps))


def distance(a: Column, b: Column) -> Column:
    """Steps between two cells of one resolution."""
    (q1, r1), (q2, r2) = axial(a), axial(b)
    dq, dr = q2 - q1, r2 - r1
    return ((F.abs(dq) + F.abs(dr) + F.abs(dq + dr)) / 2).cast("int")


def boundary_wkt(cell: Column, resolution: int) -> Column:
    """The hexagon as a polygon in WKT."""
    x, y = center(cell, resolution)
    size = radius(resolution)
    angles = [math.radians(60 * i + 30) for i in (*range(6), 0)]
    corners = [F.concat_ws(" ", (x + size * math.cos(t)).cast("string"), (y + size * math.sin(t)).cast("string")) for t in angles]
    return F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *corners), F.lit("))"))


def is_cell(text: Column) -> Column:
    return text.rlike("^[0-9a-f]{15}$")


def two_resolutions(df: DataFrame, cell: str, fine: int, coarse: int, into: str = "cell") -> DataFrame:
    """One pass over ``df`` for two resolutions: a row for the cell and one for its parent."""
    both = F.array(F.struct(F.col(cell).alias(into), F.lit(fine).alias("resolution")), F.struct(parent(F.col(cell), fine, coarse).alias(into), F.lit(coarse).alias("resolution")))
    return df.withColumn("_both", F.explode(both)).select(*(c for c in df.columns if c not in (into, "resolution")), f"_both.{into}", "_both.resolution")

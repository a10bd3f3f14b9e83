"""Hexagon cells as 64-bit keys.

The plane is tiled with regular hexagons that stand on a corner; `size` is the distance from centre to corner, in the unit of the
coordinates (degrees, or metres after a reprojection). A cell is named by two whole axial coordinates, packed into one key. Text and
polygon are made after the aggregation, once per cell.
"""

import math

from pyspark.sql import Column, functions as F

ROOT3 = math.sqrt(3.0)
_ZERO = 1 << 31
_LOW = (1 << 32) - 1


def pack(q: Column, r: Column) -> Column:
    """Key of the axial coordinates."""
    return F.shiftleft(q.cast("bigint") + F.lit(_ZERO), 32).bitwiseOR(r.cast("bigint") + F.lit(_ZERO))


def axial(key: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(key, 32) - F.lit(_ZERO), key.bitwiseAND(F.lit(_LOW)) - F.lit(_ZERO)


def _settled(rounded: list[Column], moves: list[Column]) -> tuple[Column, Column]:
    """The cube coordinate that moved furthest in rounding follows from the other two; on an equal move, as on a common border, `r`
    does."""
    (q, r, s), (dq, dr, ds) = rounded, moves
    first = (dq > dr) & (dq > ds)
    return F.when(first, -r - s).otherwise(q), F.when(~first & (dr >= ds), -q - s).otherwise(r)


def nearest_cell(q: Column, r: Column) -> tuple[Column, Column]:
    """Axial coordinates of the hexagon that holds a place given in fractions of cells."""
    cube = [q, r, -q - r]
    rounded = [F.floor(v + 0.5) for v in cube]
    return _settled(rounded, [F.abs(n - v) for n, v in zip(rounded, cube)])


def hex_key(x: Column, y: Column, size: float) -> Column:
    """Key of the hexagon that holds the point."""
    across, up = x * (ROOT3 / 3.0) - y / 3.0, y * (2.0 / 3.0)
    return pack(*nearest_cell(across / size, up / size))


def centre(key: Column, size: float) -> tuple[Column, Column]:
    q, r = (v.cast("double") for v in axial(key))
    return (q + r / 2.0) * (ROOT3 * size), r * (1.5 * size)


def hex_ring(key: Column, size: float) -> Column:
    """Counter-clockwise ring of the hexagon, from its lower right corner.

    Corners come from whole multiples of half a cell, so that neighbours share them to the last bit.
    """
    q, r = axial(key)
    # corners in half widths across and half sizes up, from the centre at (2 q + r, 3 r)
    turns = ((1, -1), (1, 1), (0, 2), (-1, 1), (-1, -1), (0, -2), (1, -1))

    def corner(across: int, up: int) -> Column:
        x = (2 * q + r + across).cast("double") * (ROOT3 / 2.0 * size)
        y = (3 * r + up).cast("double") * (size / 2.0)
        return F.struct(x.alias("x"), y.alias("y"))

    return F.array(*[corner(*t) for t in turns])


def neighbours(key: Column, reach: int = 1) -> Column:
    """Keys of all cells at most `reach` steps away, the cell itself included."""
    steps = [(a, b) for a in range(-reach, reach + 1) for b in range(-reach, reach + 1) if abs(a + b) <= reach]
    q, r = axial(key)
    return F.array(*[pack(q + a, r + b) for a, b in steps])


def steps_between(a: Column, b: Column) -> Column:
    """Number of cells to cross from one to the other."""
    (aq, ar), (bq, br) = axial(a), axial(b)
    return F.greatest(F.abs(aq - bq), F.abs(ar - br), F.abs(aq + ar - bq - br))


def parent_key(key: Column, factor: int) -> Column:
    """Key of the cell, `factor` times as large, that holds the cell's centre; in whole numbers, since centres lie on corners too."""
    q, r = axial(key)
    cube = [q, r, -q - r]
    rounded = [F.floor((2 * v + factor).cast("double") / (2.0 * factor)) for v in cube]
    return pack(*_settled(rounded, [F.abs(v - n * factor) for n, v in zip(rounded, cube)]))


def hex_text(key: Column) -> Column:
    return F.lower(F.lpad(F.hex(key), 16, "0"))

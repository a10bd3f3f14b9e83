"""Geohash cells as 64-bit keys.

A key holds the interleaved bits of a cell (longitude first), five bits per character. Grouping works on the key;
the text and the rectangle are made after the aggregation, once per cell. The key of a coarser cell is a right shift.
"""

from pyspark.sql import Column, functions as F

# Fixed value: the geohash alphabet.
ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def bit_counts(precision: int) -> tuple[int, int]:
    """Longitude and latitude bits of a cell with `precision` characters."""
    bits = 5 * precision
    return (bits + 1) // 2, bits // 2


def cell_key(lon: Column, lat: Column, precision: int) -> Column:
    """Key of the cell that holds the point. Cells are half-open; lon 180 and lat 90 go to the last cell."""
    return index_key(*cell_index(lon, lat, precision), precision)


def cell_index(lon: Column, lat: Column, precision: int) -> tuple[Column, Column]:
    """Column and row of the cell that holds the point."""
    lon_bits, lat_bits = bit_counts(precision)
    return (
        _axis_index((lon + F.lit(180.0)) / F.lit(360.0), lon_bits),
        _axis_index((lat + F.lit(90.0)) / F.lit(180.0), lat_bits),
    )


def index_key(ix: Column, iy: Column, precision: int) -> Column:
    """Interleave a cell's column and row bits."""
    lon_bits, lat_bits = bit_counts(precision)
    lon_at, lat_at = (0, 1) if lon_bits > lat_bits else (1, 0)
    key = None
    for source, bits, offset in ((ix, lon_bits, lon_at), (iy, lat_bits, lat_at)):
        for i in range(bits):
            moved = F.shiftleft(F.shiftright(source, i).bitwiseAND(F.lit(1).cast("bigint")), 2 * i + offset)
            key = moved if key is None else key.bitwiseOR(moved)
    return key


def parent_key(key: Column, precision: int, coarser: int) -> Column:
    return F.shiftright(key, 5 * (precision - coarser))


def cell_text(key: Column, precision: int) -> Column:
    """Geohash characters of a key."""
    letters = []
    for i in reversed(range(precision)):
        code = F.shiftright(key, 5 * i).bitwiseAND(F.lit(31).cast("bigint")).cast("int")
        letters.append(F.substring(F.lit(ALPHABET), code + F.lit(1), F.lit(1)))
    return F.concat(*letters)


def text_key(cell_id: Column, precision: int) -> Column:
    """Key of a geohash text with `precision` characters."""
    key = None
    for i in range(precision):
        code = (F.instr(F.lit(ALPHABET), F.substring(cell_id, i + 1, 1)) - F.lit(1)).cast("bigint")
        moved = F.shiftleft(code, 5 * (precision - 1 - i))
        key = moved if key is None else key.bitwiseOR(moved)
    return key


def cell_box(key: Column, precision: int) -> dict[str, Column]:
    """Rectangle of a cell as the columns x0, y0, x1, y1."""
    lon_bits, lat_bits = bit_counts(precision)
    lon_at, lat_at = (0, 1) if lon_bits > lat_bits else (1, 0)
    return index_box(_every_second_bit(key, lon_bits, lon_at), _every_second_bit(key, lat_bits, lat_at), precision)


def index_box(ix: Column, iy: Column, precision: int) -> dict[str, Column]:
    """Rectangle of a cell given by its column and row."""
    lon_bits, lat_bits = bit_counts(precision)
    x, y, one = ix.cast("double"), iy.cast("double"), F.lit(1.0)
    lon_cells, lat_cells = float(1 << lon_bits), float(1 << lat_bits)
    return {
        "x0": x / F.lit(lon_cells) * F.lit(360.0) - F.lit(180.0),
        "y0": y / F.lit(lat_cells) * F.lit(180.0) - F.lit(90.0),
        "x1": (x + one) / F.lit(lon_cells) * F.lit(360.0) - F.lit(180.0),
        "y1": (y + one) / F.lit(lat_cells) * F.lit(180.0) - F.lit(90.0),
    }


def _axis_index(fraction: Column, bits: int) -> Column:
    cells = 1 << bits
    index = F.floor(fraction * F.lit(float(cells))).cast("bigint")
    return F.greatest(F.least(index, F.lit(cells - 1).cast("bigint")), F.lit(0).cast("bigint"))


def _every_second_bit(key: Column, bits: int, offset: int) -> Column:
    value = None
    for i in range(bits):
        moved = F.shiftleft(F.shiftright(key, 2 * i + offset).bitwiseAND(F.lit(1).cast("bigint")), i)
        value = moved if value is None else value.bitwiseOR(moved)
    return value

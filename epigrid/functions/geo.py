"""Planar distance in degrees, unit changes and rounding."""

from pyspark.sql import Column, functions as F

from epigrid.constants import M_PER_DEG, SQKM_PER_SQDEG


def dist_deg(lon_a, lat_a, lon_b, lat_b) -> Column:
    """Planar distance in degrees. Products, not `pow`, so that every engine returns the same double."""
    dx = _col(lon_a) - _col(lon_b)
    dy = _col(lat_a) - _col(lat_b)
    return F.sqrt(dx * dx + dy * dy)


def to_metres(degrees) -> Column:
    return _col(degrees) * F.lit(M_PER_DEG)


def to_degrees(metres) -> Column:
    """Metres to degrees. The divisor is a double, so an integer radius is not cut to a short decimal."""
    return _col(metres) / F.lit(M_PER_DEG)


def to_sq_km(square_degrees) -> Column:
    return _col(square_degrees) * F.lit(SQKM_PER_SQDEG)


def round_half_up(value, digits: int = 0) -> Column:
    """Round a non-negative number, half up. Zero digits give BIGINT, otherwise DOUBLE."""
    scale = float(10**digits)
    whole = F.floor(_col(value) * F.lit(scale) + F.lit(0.5))
    return whole.cast("bigint") if digits == 0 else whole / F.lit(scale)


def is_severe(severity, severe) -> Column:
    return _col(severity).isin(*severe)


def _col(value) -> Column:
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(float(value))

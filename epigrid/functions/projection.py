"""Reprojection between longitude and latitude, metres of a UTM zone, and metres of the web map.

UTM is the transverse Mercator projection by the Krüger series to the sixth order of the third flattening, good to far less than
a millimetre inside a zone and still to millimetres some zones away. The steps of a projection are stages of named columns: on a
table they become projections whose values are computed once per row in generated code; inside an array (rings, parts) they are
bound by `let`.
"""

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from epigrid.functions.rings import let

# The WGS 84 ellipsoid, and the scale, false easting and false northing of UTM.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
SCALE = 0.9996
FALSE_EASTING = 500_000.0
FALSE_NORTHING = 10_000_000.0
# UTM covers these latitudes.
LOWEST, HIGHEST = -80.0, 84.0

# Numbers of the coordinate systems.
LON_LAT, WEB_MERCATOR, UTM_NORTH, UTM_SOUTH = 4326, 3857, 32600, 32700

# Coefficients of the series in powers of the third flattening, row j for the angle 2 j, from power j on.
_ALPHA = (
    (1 / 2, -2 / 3, 5 / 16, 41 / 180, -127 / 288, 7891 / 37800),
    (13 / 48, -3 / 5, 557 / 1440, 281 / 630, -1983433 / 1935360),
    (61 / 240, -103 / 140, 15061 / 26880, 167603 / 181440),
    (49561 / 161280, -179 / 168, 6601661 / 7257600),
    (34729 / 80640, -3418889 / 1995840),
    (212378941 / 319334400,),
)
_BETA = (
    (1 / 2, -2 / 3, 37 / 96, -1 / 360, -81 / 512, 96199 / 604800),
    (1 / 48, 1 / 15, -437 / 1440, 46 / 105, -1118711 / 3870720),
    (17 / 480, -37 / 840, -209 / 4480, 5569 / 90720),
    (4397 / 161280, -11 / 504, -830251 / 7257600),
    (4583 / 161280, -108847 / 3991680),
    (20648693 / 638668800,),
)
_DELTA = (
    (2, -2 / 3, -2, 116 / 45, 26 / 45, -2854 / 675),
    (7 / 3, -8 / 5, -227 / 45, 2704 / 315, 2323 / 945),
    (56 / 15, -136 / 35, -1262 / 105, 73814 / 2835),
    (4279 / 630, -332 / 35, -399572 / 14175),
    (4174 / 315, -144838 / 6237),
    (601676 / 22275,),
)
THIRD = FLATTENING / (2 - FLATTENING)
ECCENTRICITY = math.sqrt(FLATTENING * (2 - FLATTENING))
RECTIFYING = SEMI_MAJOR / (1 + THIRD) * (1 + THIRD**2 / 4 + THIRD**4 / 64 + THIRD**6 / 256)


def _values(rows) -> tuple[float, ...]:
    return tuple(sum(c * THIRD ** (j + k) for k, c in enumerate(row)) for j, row in enumerate(rows, 1))


ALPHA, BETA, DELTA = _values(_ALPHA), _values(_BETA), _values(_DELTA)

Env = dict[str, Column]
Stage = Callable[[Env], Env]


def utm_zone(lon: Column, lat: Column) -> Column:
    """Zone of a place, NULL outside the latitudes that UTM covers; with the wider zones of southern Norway and Svalbard."""
    plain = F.least(F.floor((lon + 180.0) / 6.0) + 1, F.lit(60)).cast("int")
    norway = (lat >= 56) & (lat < 64) & (lon >= 3) & (lon < 12)
    svalbard = F.when(lon < 9, 31).when(lon < 21, 33).when(lon < 33, 35).otherwise(37)
    far_north = (lat >= 72) & (lon >= 0) & (lon < 42)
    covered = lat.between(LOWEST, HIGHEST) & lon.between(-180.0, 180.0)
    return F.when(covered, F.when(norway, F.lit(32)).when(far_north, svalbard).otherwise(plain))


def _meridian(zone: Column) -> Column:
    return zone * 6.0 - 183.0


def _forward(north: bool | None = None) -> list[Stage]:
    """From `lon`, `lat` and `zone` to `easting`, `northing`; the false northing as told, or by the sign of the latitude."""

    def conformal(e: Env) -> Env:
        s = F.sin(F.radians(e["lat"]))
        # the turn to the meridian, taken round the globe
        turn = F.pmod(e["lon"] - _meridian(e["zone"]) + 180.0, F.lit(360.0)) - 180.0
        return {"t": F.sinh(F.atanh(s) - ECCENTRICITY * F.atanh(ECCENTRICITY * s)), "turn": F.radians(turn)}

    def sphere(e: Env) -> Env:
        c = F.cos(e["turn"])
        return {"xi": F.atan2(e["t"], c), "eta": F.asinh(F.sin(e["turn"]) / F.sqrt(e["t"] * e["t"] + c * c))}

    def plane(e: Env) -> Env:
        below = F.lit(not north) if north is not None else e["lat"] < 0
        up = F.when(below, FALSE_NORTHING).otherwise(0.0)
        along = e["eta"] + _series(ALPHA, F.cos, F.sinh, e)
        return {
            "easting": along * (SCALE * RECTIFYING) + FALSE_EASTING,
            "northing": (e["xi"] + _series(ALPHA, F.sin, F.cosh, e)) * (SCALE * RECTIFYING) + up,
        }

    return [conformal, sphere, plane]


def _inverse() -> list[Stage]:
    """From `easting`, `northing`, `zone` and `north` to `lon`, `lat`."""

    def scaled(e: Env) -> Env:
        up = F.when(e["north"], 0.0).otherwise(FALSE_NORTHING)
        return {"xi": (e["northing"] - up) / (SCALE * RECTIFYING), "eta": (e["easting"] - FALSE_EASTING) / (SCALE * RECTIFYING)}

    def sphere(e: Env) -> Env:
        return {"xi1": e["xi"] - _series(BETA, F.sin, F.cosh, e), "eta1": e["eta"] - _series(BETA, F.cos, F.sinh, e)}

    def conformal(e: Env) -> Env:
        return {"chi": F.asin(F.sin(e["xi1"]) / F.cosh(e["eta1"])), "turn": F.atan2(F.sinh(e["eta1"]), F.cos(e["xi1"]))}

    def globe(e: Env) -> Env:
        lat = e["chi"]
        for j, d in enumerate(DELTA, 1):
            lat = lat + d * F.sin(2.0 * j * e["chi"])
        lon = F.pmod(F.degrees(e["turn"]) + _meridian(e["zone"]) + 180.0, F.lit(360.0)) - 180.0
        return {"lon": lon, "lat": F.degrees(lat)}

    return [scaled, sphere, conformal, globe]


def _series(coefficients, angle, width, e: Env) -> Column:
    total = F.lit(0.0)
    for j, c in reversed([*enumerate(coefficients, 1)]):
        total = total + c * angle(2.0 * j * e["xi"]) * width(2.0 * j * e["eta"])
    return total


def _on_table(df: DataFrame, env: Env, stages: list[Stage], wanted: dict[str, str]) -> DataFrame:
    """The table with the columns that `wanted` names: name in the last stage -> name in the result."""
    name, kept = "_step_", list(df.columns)
    while any(c.lower().startswith(name) for c in kept):
        name += "_"
    df = df.withColumns({name + k: v for k, v in env.items()})
    held = set(env)
    for stage in stages:
        made = stage({k: F.col(name + k) for k in held})
        df = df.withColumns({name + k: v for k, v in made.items()})
        held |= set(made)
    new = {out: F.col(name + k).alias(out) for k, out in wanted.items()}
    return df.select(*[new.pop(c, F.col(c)) for c in kept], *new.values())


def _on_values(env: Env, stages: list[Stage]) -> Column:
    """Struct of all values of the last stage."""

    def go(stages: list[Stage], env: Env) -> Column:
        fields = F.struct(*[v.alias(k) for k, v in env.items()])
        if not stages:
            return fields
        return let(fields, lambda s: go(stages[1:], (known := {k: s[k] for k in env}) | stages[0](known)))

    return go(stages, env)


def to_utm(df: DataFrame, lon: str = "lon", lat: str = "lat", zone: int | None = None) -> DataFrame:
    """Add `utm_zone`, `utm_north`, `easting` and `northing`; NULL without coordinates or outside UTM's latitudes.

    A fixed `zone` puts all places into one plane, so that distances and areas across a zone's border make sense; all northings are
    then counted from the equator, negative in the south.
    """
    covered = F.col(lat).between(LOWEST, HIGHEST) & F.col(lon).between(-180.0, 180.0)
    env = {
        "lon": F.when(covered, F.col(lon)), "lat": F.when(covered, F.col(lat)),
        "zone": utm_zone(F.col(lon), F.col(lat)) if zone is None else F.when(covered, F.lit(zone)),
        "north": F.when(covered, F.col(lat) >= 0 if zone is None else F.lit(True)),
    }
    names = {"zone": "utm_zone", "north": "utm_north", "easting": "easting", "northing": "northing"}
    return _on_table(df, env, _forward(None if zone is None else True), names)


def from_utm(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Add `lon` and `lat` (or the names given) of `easting` and `northing` in `utm_zone`, `utm_north`."""
    env = {"easting": F.col("easting"), "northing": F.col("northing"), "zone": F.col("utm_zone"), "north": F.col("utm_north")}
    return _on_table(df, env, _inverse(), {"lon": lon, "lat": lat})


def reproject(x: Column, y: Column, source: int, target: int) -> Column:
    """A position in another coordinate system as struct<x, y>; NULL where one of the systems has no such place.

    Systems: 4326 (degrees), 3857 (web map), 32601 to 32660 and 32701 to 32760 (UTM north and south).
    """
    if source == target:
        return F.struct(x.alias("x"), y.alias("y"))
    if source == LON_LAT:
        return _project(x, y, target)
    if target == LON_LAT:
        return _unproject(x, y, source)
    return let(_unproject(x, y, source), lambda p: _project(p["x"], p["y"], target))


def reproject_ring(ring: Column, source: int, target: int) -> Column:
    """A ring in another system; edges stay straight between their corners."""
    return F.transform(ring, lambda p: reproject(p["x"], p["y"], source, target))


def reproject_parts(parts: Column, source: int, target: int) -> Column:
    """The geometry of several parts in another system."""
    return F.transform(parts, lambda rings: F.transform(rings, lambda r: reproject_ring(r, source, target)))


def _utm_of(system: int) -> tuple[int, bool]:
    for base, north in ((UTM_NORTH, True), (UTM_SOUTH, False)):
        if 1 <= system - base <= 60:
            return system - base, north
    raise ValueError(f"unknown coordinate system {system}")


def _project(lon: Column, lat: Column, system: int) -> Column:
    if system == WEB_MERCATOR:
        y = F.asinh(F.tan(F.radians(lat))) * SEMI_MAJOR
        inside = F.abs(lat) < 90.0
        return F.struct(F.when(inside, F.radians(lon) * SEMI_MAJOR).alias("x"), F.when(inside, y).alias("y"))
    zone, north = _utm_of(system)
    inside = lat.between(LOWEST, HIGHEST)
    env = {"lon": F.when(inside, lon), "lat": F.when(inside, lat), "zone": F.lit(zone)}
    return let(_on_values(env, _forward(north)), lambda v: F.struct(v["easting"].alias("x"), v["northing"].alias("y")))


def _unproject(x: Column, y: Column, system: int) -> Column:
    if system == WEB_MERCATOR:
        lat = F.degrees(F.atan(F.sinh(y / SEMI_MAJOR)))
        return F.struct(F.degrees(x / SEMI_MAJOR).alias("x"), lat.alias("y"))
    zone, north = _utm_of(system)
    env = {"easting": x, "northing": y, "zone": F.lit(zone), "north": F.lit(north)}
    return let(_on_values(env, _inverse()), lambda v: F.struct(v["lon"].alias("x"), v["lat"].alias("y")))

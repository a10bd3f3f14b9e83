"""Rings: closed `array<struct<x, y>>` with the first vertex repeated at the end.

A geometry of several rings is a column of parts, `array<array<ring>>`: each part is an outer ring and its holes.
"""

from pyspark.sql import Column, functions as F

from epigrid.constants import APOTHEM, NORMALS, SIDES, VERTICES

RING_TYPE = "array<struct<x:double,y:double>>"
PARTS_TYPE = f"array<array<{RING_TYPE}>>"


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Counter-clockwise ring of a rectangle, from its lower left corner."""
    corners = ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))
    return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in corners])


def buffer_ring(lon: Column, lat: Column, radius_deg: Column) -> Column:
    """Ring of the buffer polygon around a point."""
    turns = [*VERTICES, VERTICES[0]]
    return F.array(
        *[
            F.struct((lon + radius_deg * F.lit(c)).alias("x"), (lat + radius_deg * F.lit(s)).alias("y"))
            for c, s in turns
        ]
    )


def ring_edges(ring: Column) -> Column:
    """Edges of a ring as `array<struct<a, b>>`."""
    return F.transform(
        F.sequence(F.lit(1), F.size(ring) - F.lit(1)),
        lambda i: F.struct(F.element_at(ring, i).alias("a"), F.element_at(ring, i + F.lit(1)).alias("b")),
    )


def inside_edges(edges: Column, x: Column, y: Column) -> Column:
    """Closed point-in-polygon test on the edges of a ring (a point on an edge is inside)."""

    def on_edge(e):
        a, b = e["a"], e["b"]
        cross = (b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"])
        return (
            (cross == F.lit(0.0))
            & x.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"]))
            & y.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))
        )

    def crosses(e):
        a, b = e["a"], e["b"]
        x_at = a["x"] + (y - a["y"]) * (b["x"] - a["x"]) / F.nullif(b["y"] - a["y"], F.lit(0.0))
        return ((a["y"] > y) != (b["y"] > y)) & (x < x_at)

    odd = F.aggregate(edges, F.lit(False), lambda acc, e: acc != F.coalesce(crosses(e), F.lit(False)))
    return F.exists(edges, on_edge) | odd


def parts_edges(parts: Column) -> Column:
    """Edges of all rings. Crossing counts over them respect holes and islands."""
    return F.flatten(F.transform(F.flatten(parts), ring_edges))


def parts_area(parts: Column) -> Column:
    """Area in square degrees: outer rings less their holes, whichever way the rings run."""
    zero = F.lit(0.0)

    def part(rings):
        holes = F.aggregate(F.slice(rings, 2, F.size(rings)), zero, lambda acc, r: acc + ring_area(r))
        return ring_area(F.element_at(rings, 1)) - holes

    return F.aggregate(parts, zero, lambda acc, rings: acc + part(rings))


def parts_centroid(parts: Column) -> Column:
    """Area-weighted centroid of all parts less their holes, as struct<x, y>."""

    def weigh(ring, sign):
        return let(
            F.struct(ring_area(ring).alias("a"), ring_centroid(ring).alias("c")),
            lambda m: F.struct((m["a"] * sign).alias("a"), m["c"]["x"].alias("x"), m["c"]["y"].alias("y")),
        )

    signed = F.flatten(
        F.transform(parts, lambda rings: F.transform(rings, lambda r, i: weigh(r, F.when(i == 0, 1.0).otherwise(-1.0))))
    )
    total = lambda rows, name: F.aggregate(rows, F.lit(0.0), lambda acc, m: acc + m["a"] * (m[name] if name else F.lit(1.0)))
    return let(
        signed, lambda rows: F.struct((total(rows, "x") / total(rows, "")).alias("x"), (total(rows, "y") / total(rows, "")).alias("y"))
    )


def ring_contains(ring: Column, x: Column, y: Column) -> Column:
    return inside_edges(ring_edges(ring), x, y)


def ring_area(ring: Column) -> Column:
    """Area in square degrees (shoelace, relative to the first vertex)."""
    return let(ring, lambda r: F.abs(_moments(r)["a2"]) / F.lit(2.0))


def ring_centroid(ring: Column) -> Column:
    """Area-weighted centroid as struct<x, y>."""

    def place(r):
        first = F.element_at(r, 1)
        return let(
            _moments(r),
            lambda m: F.struct(
                (first["x"] + m["mx"] / (F.lit(3.0) * m["a2"])).alias("x"),
                (first["y"] + m["my"] / (F.lit(3.0) * m["a2"])).alias("y"),
            ),
        )

    return let(ring, place)


def let(value: Column, use) -> Column:
    """`use(value)` with the value computed once, however often it is named in the result."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _moments(ring: Column) -> Column:
    zero = F.struct(F.lit(0.0).alias("a2"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))
    first = F.element_at(ring, 1)

    def step(acc, e):
        ax, ay = e["a"]["x"] - first["x"], e["a"]["y"] - first["y"]
        bx, by = e["b"]["x"] - first["x"], e["b"]["y"] - first["y"]
        cross = ax * by - bx * ay
        return F.struct(
            (acc["a2"] + cross).alias("a2"),
            (acc["mx"] + (ax + bx) * cross).alias("mx"),
            (acc["my"] + (ay + by) * cross).alias("my"),
        )

    return F.aggregate(ring_edges(ring), zero, step)


def number_text(value: Column) -> Column:
    """Coordinate as text with nine decimals, rounded half up."""
    units = F.floor(value * F.lit(1e9) + F.lit(0.5)).cast("decimal(18,0)")
    return (units * F.lit("0.000000001").cast("decimal(9,9)")).cast("string")


def point_wkt(lon: Column, lat: Column) -> Column:
    return F.concat(F.lit("POINT("), number_text(lon), F.lit(" "), number_text(lat), F.lit(")"))


def ring_wkt(ring: Column) -> Column:
    """Polygon text of a ring."""
    return F.concat(F.lit("POLYGON("), vertex_text(ring), F.lit(")"))


def parts_wkt(parts: Column) -> Column:
    """Polygon text, or a multipolygon text if there are several parts."""

    def body(rings):
        return F.concat(F.lit("("), F.array_join(F.transform(rings, vertex_text), ", "), F.lit(")"))

    texts = F.transform(parts, body)
    many = F.concat(F.lit("MULTIPOLYGON("), F.array_join(texts, ", "), F.lit(")"))
    return F.when(F.size(parts) > 1, many).otherwise(F.concat(F.lit("POLYGON"), F.element_at(texts, 1)))


def vertex_text(ring: Column) -> Column:
    pairs = F.transform(ring, lambda p: F.concat(number_text(p["x"]), F.lit(" "), number_text(p["y"])))
    return F.concat(F.lit("("), F.array_join(pairs, ", "), F.lit(")"))


def buffer_meets_box(lon: Column, lat: Column, radius_deg: Column, x0, y0, x1, y1) -> Column:
    """Closed test of a buffer polygon against a rectangle, by separating axes.

    The buffer is symmetric in both axes, so only normals of the first quadrant are needed, applied to the signed gap
    between the centre and the rectangle on each axis.
    """
    gap_x = F.greatest(x0 - lon, lon - x1)
    gap_y = F.greatest(y0 - lat, lat - y1)
    apart = (gap_x > radius_deg) | (gap_y > radius_deg)
    reach = radius_deg * F.lit(APOTHEM)
    for nx, ny in NORMALS[: SIDES // 4]:
        apart = apart | (gap_x * F.lit(nx) + gap_y * F.lit(ny) > reach)
    return ~apart

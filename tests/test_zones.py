"""Merged areas against an independent method, and the thinning of crowded places."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from epigrid.constants import SIDES, UNIT_AREA, VERTICES
from epigrid.functions.rings import parts_area, parts_wkt
from epigrid.operators import zones

R = 1000 / 111000.0


def slab_area(centres, r):
    """Exact area of the union by horizontal slabs between all vertex and crossing heights."""
    discs = [[(x + r * c, y + r * s) for c, s in VERTICES] for x, y in sorted(set(centres))]
    edges = [(p, d[(i + 1) % SIDES]) for d in discs for i, p in enumerate(d)]
    heights = {p[1] for d in discs for p in d}
    for i, (a, b) in enumerate(edges):
        for c, d in edges[i + 1 :]:
            y = crossing(a, b, c, d)
            if y is not None:
                heights.add(y)
    ys = sorted(heights)
    total = 0.0
    for low, high in zip(ys, ys[1:]):
        if high - low < 1e-15:
            continue
        y = (low + high) / 2
        spans = sorted(s for s in (span(d, y) for d in discs) if s)
        covered, end = 0.0, -math.inf
        for left, right in spans:
            covered += max(0.0, right - max(left, end))
            end = max(end, right)
        total += covered * (high - low)
    return total


def span(disc, y):
    xs = []
    for i, (x1, y1) in enumerate(disc):
        x2, y2 = disc[(i + 1) % SIDES]
        if (y1 > y) != (y2 > y):
            xs.append(x1 + (y - y1) * (x2 - x1) / (y2 - y1))
    return (min(xs), max(xs)) if xs else None


def crossing(a, b, c, d):
    ux, uy, vx, vy = b[0] - a[0], b[1] - a[1], d[0] - c[0], d[1] - c[1]
    det = ux * vy - uy * vx
    if abs(det) < 1e-18:
        return None
    s = ((c[0] - a[0]) * vy - (c[1] - a[1]) * vx) / det
    t = ((c[0] - a[0]) * uy - (c[1] - a[1]) * ux) / det
    return a[1] + s * uy if 0 <= s <= 1 and 0 <= t <= 1 else None


def merged(spark, groups, steps=zones.THIN_STEPS):
    """Merged area per named group of centres."""
    data = [(name, 1000, x, y) for name, centres in groups.items() for x, y in centres]
    df = spark.createDataFrame(data, "g string, radius_meters int, lon double, lat double")
    return {r["g"]: r["area_deg2"] for r in zones.union_area(df, ["g"], steps).collect()}


def scattered(seed, count, spread):
    rng = random.Random(seed)
    return [(100 + rng.uniform(0, spread * R), 13 + rng.uniform(0, spread * R)) for _ in range(count)]


def test_slab_area_of_one_buffer():
    assert slab_area([(100.0, 13.0)], R) == pytest.approx(R * R * UNIT_AREA, rel=1e-9)


def test_against_slabs(spark):
    turn = math.pi / SIDES
    back = 2 * R * math.cos(turn)
    groups = {
        "one": [(100.0, 13.0)],
        "same": [(100.0, 13.0)] * 3,
        "apart": [(100.0, 13.0), (100.0 + 3 * R, 13.0)],
        "touching": [(100.0, 13.0), (100.0 + back * math.cos(turn), 13.0 + back * math.sin(turn))],
        "ring with a hole": [
            (100 + 2 * R * math.cos(i * math.pi / 8), 13 + 2 * R * math.sin(i * math.pi / 8)) for i in range(16)
        ],
        "few": scattered(1, 12, 2.0),
        "wide": scattered(2, 25, 4.0),
        "dense": scattered(3, 40, 1.0),
    }
    for share in (0.1, 0.7, 3.0):
        along = share * R * math.sin(turn)
        groups[f"along an edge {share}"] = [
            (100.0, 13.0), (100.0 - along * math.sin(turn), 13.0 + along * math.cos(turn)),
        ]
    found = merged(spark, groups)
    for name, centres in groups.items():
        assert found[name] == pytest.approx(slab_area(centres, R), rel=1e-6), name


def test_thinning_keeps_the_union(spark):
    groups = {"wide": scattered(5, 2500, 2.0), "mid": scattered(6, 800, 0.6)}
    thinned, plain = merged(spark, groups), merged(spark, groups, steps=0)
    assert thinned == pytest.approx(plain, rel=1e-9)


def test_thinning_bounds_a_hot_spot(spark):
    """400,000 centres in a place two radii wide: representatives, a thin rim and uncrowded cells are left."""
    centres = spark.range(400_000).select(
        F.lit("g").alias("g"),
        F.lit(1000).alias("radius_meters"),
        (F.lit(100.0) + F.rand(1) * F.lit(2 * R)).alias("lon"),
        (F.lit(13.0) + F.rand(2) * F.lit(2 * R)).alias("lat"),
        F.col("id").alias("_id"),
        F.lit(R).alias("_r"),
        F.lit(0).cast("bigint").alias("_hidden"),
    )
    assert zones.thin(centres, ["g", "radius_meters"]).count() < 100_000


def test_evenly_crowded_places_are_thinned(spark):
    """Four centres a cell, below the bound of a hot cell: inside the place one centre a cell is left and no edge of it is open."""
    groups = {"even": scattered(8, 12_000, 13.0), "holes": [p for p in scattered(9, 6_000, 12.0) if math.hypot(p[0] - 100.05, p[1] - 13.05) > 2 * R]}
    data = [(name, 1000, x, y) for name, centres in groups.items() for x, y in centres]
    df = spark.createDataFrame(data, "g string, radius_meters int, lon double, lat double")
    left = zones.thin(zones.distinct_centres(df, ["g"]), ["g", "radius_meters"]).cache()
    assert left.count() < 0.7 * len(data)
    assert left.filter(F.col("_hidden") != zones.ALL_EDGES).count() < 0.5 * len(data)
    assert merged(spark, groups) == pytest.approx(merged(spark, groups, steps=0), rel=1e-9)


def test_outline_closes(located):
    pieces = zones.outline(zones.tiers_of(located.select("region_name", "lon", "lat")), ["region_name"])
    sums = pieces.groupBy("region_name", "radius_meters").agg(
        F.sum(F.col("to_x") - F.col("from_x")).alias("x"), F.sum(F.col("to_y") - F.col("from_y")).alias("y")
    )
    assert all(abs(r["x"]) < 1e-9 and abs(r["y"]) < 1e-9 for r in sums.collect())


def test_merged_grows_with_radius(located):
    areas = rows(zones.risk_zones(located), "region_name", "radius_meters", "area_sq_km", "naive_sq_km")
    by_region = [areas[i : i + 3] for i in range(0, 9, 3)]
    assert all(a[2] < b[2] for group in by_region for a, b in zip(group, group[1:]))
    assert all(a[2] <= a[3] for a in areas)


def test_tiers_from_a_table(small):
    assert zones.cross_tiers(small["cases"], small["risk_tiers"]).count() == 90


def test_rings(spark):
    """A ring of buffers has one outer ring and one hole; both close and their areas add up to the union."""
    centres = [(100 + 2 * R * math.cos(i * math.pi / 8), 13 + 2 * R * math.sin(i * math.pi / 8)) for i in range(16)]
    groups = {"hole": centres, "one": [(100.0, 13.0)], "two": [(100.0, 13.0), (100.0 + R, 13.0 + 0.3 * R)]}
    data = [(name, 1000, x, y) for name, places in groups.items() for x, y in places]
    df = spark.createDataFrame(data, "g string, radius_meters int, lon double, lat double")
    vertices = zones.rings(df, ["g"])
    summary = zones.ring_summary(vertices, ["g"]).collect()
    signs = {name: sorted(r["area_deg2"] > 0 for r in summary if r["g"] == name) for name in groups}
    assert signs == {"hole": [False, True], "one": [True], "two": [True]}
    for name, places in groups.items():
        total = sum(r["area_deg2"] for r in summary if r["g"] == name)
        assert total == pytest.approx(slab_area(places, R), rel=1e-6)
    by_ring = {}
    for r in vertices.collect():
        by_ring.setdefault((r["g"], r["ring"]), []).append((r["seq"] is not None, r["seq"] or 0, r["x"], r["y"], r["to_x"], r["to_y"]))
    for points in by_ring.values():
        points.sort()
        for now, after in zip(points, points[1:] + points[:1]):
            assert abs(now[4] - after[2]) < 1e-9 and abs(now[5] - after[3]) < 1e-9
    texts = zones.ring_texts(vertices, ["g"]).collect()
    assert len(texts) == 4 and all(t["wkt"].startswith("POLYGON((") for t in texts)
    one = next(t["wkt"] for t in texts if t["g"] == "one")
    corners = one[len("POLYGON((") : -2].split(", ")
    assert len(corners) == SIDES + 1 and corners[0] == corners[-1]


@pytest.mark.parametrize("spacing", [1.0, math.sqrt(2), 1.5, 2.0, 2 * math.cos(math.pi / SIDES)])
def test_rings_of_lattices(spark, spacing):
    """Regular layouts, where many buffers cross at one point: every outline closes and the areas add up."""
    places = [(100 + spacing * R * i, 13 + spacing * R * j) for i in range(4) for j in range(4)]
    df = spark.createDataFrame([("g", 1000, x, y) for x, y in places], "g string, radius_meters int, lon double, lat double")
    vertices = zones.rings(df, ["g"])
    total = sum(r["area_deg2"] for r in zones.ring_summary(vertices, ["g"]).collect())
    assert total == pytest.approx(slab_area(places, R), rel=1e-6)


def test_zone_geometry(spark):
    """Outer rings with their holes, also with an island in a hole; one geometry per zone, and its area is the union's."""
    ring = [(100 + 4 * R * math.cos(i * math.pi / 16), 13 + 4 * R * math.sin(i * math.pi / 16)) for i in range(32)]
    places = {"island": [*ring, (100.0, 13.0)], "two": [(100.0, 13.0), (100 + 5 * R, 13.0)]}
    data = [(g, 1000, x, y) for g, p in places.items() for x, y in p]
    df = spark.createDataFrame(data, "g string, radius_meters int, lon double, lat double")
    shapes = zones.zone_parts(zones.rings(df, ["g"]), ["g"])
    found = {r["g"]: r for r in shapes.select("g", "parts", parts_area(F.col("parts")).alias("a"), parts_wkt(F.col("parts")).alias("w")).collect()}
    assert sorted(len(p) for p in found["island"]["parts"]) == [1, 2] and [len(p) for p in found["two"]["parts"]] == [1, 1]
    for g, p in places.items():
        assert found[g]["a"] == pytest.approx(slab_area(p, R), rel=1e-6) and found[g]["w"].startswith("MULTIPOLYGON(((")
    again = zones.zone_parts(zones.rings(df.orderBy(F.desc("lat")), ["g"]), ["g"]).select("g", parts_wkt(F.col("parts")).alias("w"))
    assert {r["g"]: r["w"] for r in again.collect()} == {g: r["w"] for g, r in found.items()}


def test_a_hundred_thousand_holes(spark):
    """A square with a lattice of holes, each touching none, and islands with a hole of their own in some of them: every hole finds its
    ring, in a number of rounds that does not grow with the holes and without pairing them with rings."""
    r = 1000 / 111000.0
    n, step = 316, 0.5 * r
    unit = 0.1 * r
    width = (n + 1) * step

    def square(x, y, size, hole):
        corners = [(x, y), (x + size, y), (x + size, y + size), (x, y + size)]
        corners = corners[::-1] if hole else corners
        return list(zip(corners, corners[1:] + corners[:1]))

    pieces = []
    cuts = int(width / (0.15 * r)) + 1
    for (ax, ay), (bx, by) in square(100.0, 13.0, width, False):
        pieces += [(0, ax + (bx - ax) * k / cuts, ay + (by - ay) * k / cuts, ax + (bx - ax) * (k + 1) / cuts, ay + (by - ay) * (k + 1) / cuts) for k in range(cuts)]
    ring = 0
    wanted = {}
    for i in range(n):
        for j in range(n):
            ring += 1
            x, y = 100.0 + (i + 0.6) * step, 13.0 + (j + 0.6) * step
            wanted[ring] = 0
            pieces += [(ring, *a, *b) for a, b in square(x, y, 2 * unit, True)]
            if (i * n + j) % 97 == 0:  # an island and its hole
                pieces += [(ring + 1_000_000, *a, *b) for a, b in square(x + 0.5 * unit, y + 0.5 * unit, unit, False)]
                pieces += [(ring + 2_000_000, *a, *b) for a, b in square(x + 0.7 * unit, y + 0.7 * unit, 0.4 * unit, True)]
                wanted[ring + 2_000_000] = ring + 1_000_000
    frame = pd.DataFrame(pieces, columns=["ring", "x", "y", "to_x", "to_y"]).assign(g="z", radius_meters=1000, seq=0)
    vertices = spark.createDataFrame(frame)
    owners = zones.hole_owners(vertices, ["g"])
    assert {r["hole"]: r["outer"] for r in owners.collect()} == wanted and len(wanted) > 100_000


def test_a_hole_does_not_own_itself(spark):
    """The end of a piece may lie a rounding error left of where the next one starts; following owners used to go round for ever."""
    outer = [(100.0, 13.0), (101.0, 13.0), (101.0, 14.0), (100.0, 14.0)]
    hole = [(100.5, 13.5), (100.6, 13.6), (100.6, 13.4)]
    pieces = [(n, *a, *b) for n, p in ((0, outer), (1, hole)) for a, b in zip(p, p[1:] + p[:1])]
    # the piece into the hole's leftmost vertex comes from above and ends too far left
    reversed_hole = [(1, 100.5, 13.5, 100.6, 13.6), (1, 100.6, 13.6, 100.6, 13.4), (1, 100.6, 13.4, math.nextafter(100.5, 0), math.nextafter(13.5, 14))]
    pieces = [p for p in pieces if p[0] == 0] + reversed_hole
    frame = pd.DataFrame(pieces, columns=["ring", "x", "y", "to_x", "to_y"]).assign(g="z", radius_meters=100_000, seq=0)
    owners = zones.hole_owners(spark.createDataFrame(frame), ["g"])
    assert [(r["hole"], r["outer"]) for r in owners.collect()] == [(1, 0)]


def test_pieces_end_where_the_next_one_starts(spark):
    places = [(100 + 0.3 * R * i, 13 + 0.7 * R * j) for i in range(5) for j in range(4)]
    df = spark.createDataFrame([("g", 1000, x, y) for x, y in places], "g string, radius_meters int, lon double, lat double")
    vertices = zones.rings(df, ["g"]).collect()
    starts = {(r["x"], r["y"]) for r in vertices}
    assert vertices and {(r["to_x"], r["to_y"]) for r in vertices} == starts

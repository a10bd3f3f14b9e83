"""Reprojection against published places and round trips; hexagons against a plain search of the nearest centre."""

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from epigrid.functions import hexgrid, projection, rings
from epigrid.operators import hexmap, scoring
from epigrid.operators.regions import assign_region
from epigrid.sources import ingest

# Places with published UTM coordinates (zone, easting, northing) and how exactly they are published.
PLACES = [
    (44.4, 33.3, 38, 444140.54, 3684706.36, 0.01),
    (-79.387139, 43.642567, 17, 630084.0, 4833438.0, 2.0),
    (0.0, 0.0, 31, 166021.443, 0.0, 0.001),
]


def test_published_places(spark):
    df = spark.createDataFrame([p[:2] for p in PLACES], "lon double, lat double")
    found = {(r["lon"], r["lat"]): r for r in projection.to_utm(df).collect()}
    for lon, lat, zone, east, north, exact in PLACES:
        r = found[lon, lat]
        assert r["utm_zone"] == zone and r["utm_north"]
        assert r["easting"] == pytest.approx(east, abs=exact) and r["northing"] == pytest.approx(north, abs=exact)


def test_round_trip_over_the_globe(spark):
    rng = random.Random(1)
    places = [(rng.uniform(-180, 180), rng.uniform(-80, 84)) for _ in range(3000)]
    places += [(-180.0, 10.0), (180.0, 10.0), (179.999, -79.9), (5.0, 60.0), (10.0, 78.0), (34.0, 75.0)]
    odd = [(None, 1.0), (1.0, None), (5.0, 84.5), (5.0, -89.0), (400.0, 3.0), (float("nan"), 3.0)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(places + odd)], "id int, lon double, lat double")
    back = projection.from_utm(projection.to_utm(df), "lon2", "lat2").orderBy("id").collect()
    for r in back[: len(places)]:
        turn = (r["lon2"] - r["lon"] + 180) % 360 - 180
        assert abs(turn) * 111320 * math.cos(math.radians(r["lat"])) < 1e-3 and abs(r["lat2"] - r["lat"]) * 111320 < 1e-3
        assert r["northing"] >= 0 and (160_000 < r["easting"] < 840_000 or r["lat"] > 55)
    for r in back[len(places) :]:
        assert r["utm_zone"] is None and r["easting"] is None and r["lon2"] is None
    zones = {(r["lon"], r["lat"]): r["utm_zone"] for r in back}
    assert (zones[5.0, 60.0], zones[10.0, 78.0], zones[34.0, 75.0], zones[180.0, 10.0], zones[-180.0, 10.0]) == (32, 33, 37, 60, 1)


def test_arrays_and_tables_agree(spark):
    """The form for arrays gives what the form for tables gives, for every system."""
    df = spark.range(200).select((F.rand(3) * 6 + 99).alias("lon"), (F.rand(4) * 20 + 1).alias("lat"))
    utm = projection.to_utm(df, zone=47).withColumn("p", projection.reproject(F.col("lon"), F.col("lat"), 4326, 32647))
    assert utm.filter((F.abs(F.col("p.x") - F.col("easting")) > 1e-6) | (F.abs(F.col("p.y") - F.col("northing")) > 1e-6)).count() == 0
    for system in (32647, 32747, 3857, 4326):
        there = projection.reproject(F.col("lon"), F.col("lat"), 4326, system)
        back = df.withColumn("p", there).withColumn("q", projection.reproject(F.col("p.x"), F.col("p.y"), system, 4326))
        assert back.filter(F.greatest(F.abs(F.col("q.x") - F.col("lon")), F.abs(F.col("q.y") - F.col("lat"))) > 1e-9).count() == 0
    around = df.withColumn("p", projection.reproject(F.col("lon"), F.col("lat"), 4326, 32647))
    over = around.withColumn("q", projection.reproject(F.col("p.x"), F.col("p.y"), 32647, 3857)).withColumn("d", projection.reproject(F.col("lon"), F.col("lat"), 4326, 3857))
    assert over.filter(F.abs(F.col("q.x") - F.col("d.x")) + F.abs(F.col("q.y") - F.col("d.y")) > 1e-3).count() == 0
    with pytest.raises(ValueError):
        projection.reproject(F.col("lon"), F.col("lat"), 4326, 32661)


def test_area_of_a_square_kilometre(spark):
    """A square of a kilometre in metres, taken to degrees and back."""
    side = [(500_000.0, 1_500_000.0), (501_000.0, 1_500_000.0), (501_000.0, 1_501_000.0), (500_000.0, 1_501_000.0), (500_000.0, 1_500_000.0)]
    df = spark.createDataFrame([([[side]],)], f"parts {rings.PARTS_TYPE}")
    degrees = df.withColumn("parts", projection.reproject_parts(F.col("parts"), 32647, 4326))
    corner = degrees.first()["parts"][0][0][0]
    assert corner["x"] == pytest.approx(99.0) and 13 < corner["y"] < 14
    back = degrees.select(rings.parts_area(projection.reproject_parts(F.col("parts"), 4326, 32647)).alias("a")).first()["a"]
    assert back == pytest.approx(1e6, abs=1e-3)


def points(spark, n, size):
    rng = random.Random(2)
    data = [(i, rng.uniform(-9, 9) * size, rng.uniform(-9, 9) * size) for i in range(n)]
    return data, spark.createDataFrame(data + [(n, None, 1.0)], "id int, lon double, lat double")


@pytest.mark.parametrize("size", [0.01, 250.0])
def test_every_point_lies_in_its_hexagon(spark, size):
    data, df = points(spark, 800, size)
    keyed = df.filter("lon IS NOT NULL").withColumn("k", hexgrid.hex_key(F.col("lon"), F.col("lat"), size))
    x, y = hexgrid.centre(F.col("k"), size)
    found = keyed.withColumns({"x": x, "y": y, "ring": hexgrid.hex_ring(F.col("k"), size)})
    found = found.withColumn("inside", rings.ring_contains(F.col("ring"), F.col("lon"), F.col("lat"))).collect()
    centres = [(math.sqrt(3) * size * (q + r / 2), 1.5 * size * r) for q in range(-20, 21) for r in range(-20, 21)]
    for row in found:
        near = min(centres, key=lambda c: (row["lon"] - c[0]) ** 2 + (row["lat"] - c[1]) ** 2)
        assert row["inside"] and (row["x"], row["y"]) == pytest.approx(near)
    area = keyed.select(rings.ring_area(hexgrid.hex_ring(F.col("k"), size)).alias("a")).first()["a"]
    assert area == pytest.approx(1.5 * math.sqrt(3) * size**2)


def test_heatmap_counts_rollup_and_neighbourhood(spark):
    data, df = points(spark, 500, 0.01)
    cases = df.withColumn("severity", F.when(F.col("id") % 3 == 0, "DHF").otherwise("DF"))
    counts = hexmap.hex_counts(cases)
    assert counts.agg(F.sum("case_count"), F.sum("severe_count")).first()[:] == (500, 167)
    assert hexmap.hex_heatmap(cases).columns == ["case_count", "severe_count", "hex_id", "ring"]
    rolled = hexmap.hex_rollup(counts, 3)
    assert rolled.agg(F.sum("case_count"), F.sum("severe_count"), F.sum("cells")).first()[:] == (500, 167, counts.count())
    assert rolled.count() < counts.count() / 4
    held = {r["_hex"]: r["case_count"] for r in counts.collect()}
    axial = {k: ((k >> 32 & 0xFFFFFFFF) - (1 << 31), (k & 0xFFFFFFFF) - (1 << 31)) for k in held}
    steps = lambda a, b: max(abs(a[0] - b[0]), abs(a[1] - b[1]), abs(sum(a) - sum(b)))
    for reach in (1, 2):
        found = dict(rows(hexmap.hex_neighbourhood(counts, reach), "_hex", "nearby_count"))
        assert found == {a: sum(n for b, n in held.items() if steps(axial[a], axial[b]) <= reach) for a in held}
    pairs = counts.alias("a").join(counts.alias("b")).select(hexgrid.steps_between(F.col("a._hex"), F.col("b._hex")).alias("d"))
    assert pairs.filter("d = 0").count() == len(held)
    assert hexmap.hex_rollup(hexmap.hex_counts(cases.limit(0))).count() == 0


def test_repeated_regions_keep_their_points(spark):
    """A region listed twice, two shapes under the same attributes and box, and copies with other attributes."""
    box = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]
    hole = [(0.2, 0.2), (0.2, 0.8), (0.8, 0.8), (0.8, 0.2), (0.2, 0.2)]
    shapes = [("a", [[box]]), ("a", [[box]]), ("a", [[box, hole]]), ("b", [[box]]), ("c", [[box, hole], [[(2.0, 2.0), (3.0, 2.0), (2.0, 3.0), (2.0, 2.0)]]])]
    regs = ingest.with_box(spark.createDataFrame(shapes, f"region_name string, parts {rings.PARTS_TYPE}"))
    rng = random.Random(3)
    data = [(i, rng.uniform(-0.2, 3.2), rng.uniform(-0.2, 3.2)) for i in range(600)] + [(900, 0.5, 0.5), (901, 0.2, 0.5), (902, 1.0, 1.0)]
    cases = spark.createDataFrame(data, "case_id int, lon double, lat double")
    plain = cases.crossJoin(regs).filter(rings.inside_edges(rings.parts_edges(F.col("parts")), F.col("lon"), F.col("lat")))
    found = assign_region(cases, regs)
    assert found.columns == ["case_id", "lon", "lat", "region_name"]
    assert rows(found, "case_id", "region_name") == rows(plain, "case_id", "region_name")
    assert rows(found.filter("case_id = 900"), "region_name") == [("a",), ("a",), ("b",)]
    ringed = spark.createDataFrame([("a", box, 0.0, 0.0, 1.0, 1.0)] * 3, "region_name string, ring array<struct<x:double,y:double>>, x0 double, y0 double, x1 double, y1 double")
    assert assign_region(cases, ringed).count() == 3 * assign_region(cases, ringed.limit(1)).count() > 0


def test_borders_through_the_corners_of_cells(spark):
    """Edges through corners of the cover's cells and vertices on them: rounding decides nothing."""
    shapes = [
        ("slanted", [[[(101.1, 17.0), (101.9, 17.2), (101.7, 18.0), (101.1, 17.8), (101.1, 17.0)]]]),
        ("lattice", [[[(100.0, 17.0), (100.5, 17.25), (100.25, 17.75), (99.75, 17.5), (100.0, 17.0)], [(100.05, 17.2), (100.2, 17.35), (100.05, 17.5), (100.05, 17.2)]]]),
    ]
    regs = ingest.with_box(spark.createDataFrame(shapes, f"region_name string, parts {rings.PARTS_TYPE}"))
    rng = random.Random(8)
    data = [(i, round(rng.uniform(99.7, 102.0), 4), round(rng.uniform(16.9, 18.1), 4)) for i in range(6000)]
    data += [(10_000 + i, 99.7 + 0.05 * (i % 47), 16.95 + 0.05 * (i // 47)) for i in range(47 * 23)]
    cases = spark.createDataFrame(data, "case_id int, lon double, lat double")
    plain = cases.crossJoin(regs).filter(rings.inside_edges(rings.parts_edges(F.col("parts")), F.col("lon"), F.col("lat")))
    assert rows(assign_region(cases, regs), "case_id", "region_name") == rows(plain, "case_id", "region_name")


def test_scoring_by_hexagon_of_metres(spark, small):
    """Hexagons of five hundred metres on reprojected cases hold every case once."""
    metres = projection.to_utm(small["cases"], zone=47)
    counts = hexmap.hex_counts(metres, 500.0, x="easting", y="northing")
    assert counts.agg(F.sum("case_count")).first()[0] == small["cases"].count()
    assert scoring.count_if(F.lit(True)) is not None

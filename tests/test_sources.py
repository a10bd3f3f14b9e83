"""Ingest, exports, tables and features."""

import json
import math
import random
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import rows
from epigrid.functions import geohash, rings
from epigrid.functions.colours import ramp_colour
from epigrid.operators import features, heatmap, regions, zones
from epigrid.plans.batch import build_tables, refresh_months
from epigrid.sources import ingest, schemas, tables


def test_point_texts(spark):
    texts = ["POINT(100.5 13.7)", " point ( -1e2  .5 ) ", "", "POINT(1)", "POINT(a b)", "POINT(1 2) x", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, wkt string")
    good, bad = ingest.ingest_wkt(df, "wkt")
    assert rows(good, "id", "lon", "lat") == [(0, 100.5, 13.7), (1, -100.0, 0.5)]
    assert rows(bad, "id") == [(2,), (3,), (4,), (5,), (6,)]


def test_polygon_texts(spark):
    texts = [
        "POLYGON((0 0, 2 0, 2 1, 0 1, 0 0))", "POLYGON((0 0, 2 0, 2 1, 0 1))", "POLYGON((0 0, x 0, 2 1, 0 0))", "POINT(1 2)", None,
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, wkt string")
    good, bad = ingest.ingest_wkt(df, "wkt", kind="polygon")
    row = good.select("id", "x0", "x1", "y1", rings.ring_area(F.col("ring")).alias("a"), rings.ring_centroid(F.col("ring")).alias("c")).first()
    assert (row["id"], row["x0"], row["x1"], row["y1"], row["a"], tuple(row["c"])) == (0, 0.0, 2.0, 1.0, 2.0, (1.0, 0.5))
    assert rows(bad, "id") == [(1,), (2,), (3,), (4,)]
    with pytest.raises(ValueError):
        ingest.ingest_wkt(df, "wkt", kind="line")


def test_points_in_any_ring(spark):
    """A concave region: inside, in the notch, on the border, on a vertex, outside."""
    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.5, 0.4), (0.0, 1.0), (0.0, 0.0)]
    regs = ingest.with_box(spark.createDataFrame([("r", ring)], f"region_name string, ring {rings.RING_TYPE}"))
    points = [(0.25, 0.25), (0.5, 0.8), (0.0, 0.5), (1.0, 1.0), (0.5, 0.4), (1.5, 0.5), (0.9, 0.85), (0.5, 0.35), (0.333, 0.0)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "case_id int, lon double, lat double")
    assert rows(regions.assign_region(df, regs), "case_id") == [(0,), (2,), (3,), (4,), (6,), (7,), (8,)]


def test_random_shapes_as_regions(spark):
    """Jagged rings with holes, points on corners and sides: the cover agrees with the test on all edges."""
    rng = random.Random(5)

    def jagged(x, y, r, n):
        turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
        ring = [(round(x + r * rng.uniform(0.5, 1) * math.cos(t), 3), round(y + r * rng.uniform(0.5, 1) * math.sin(t), 3)) for t in turns]
        return ring + ring[:1]

    shapes = [
        [[jagged(0, 0, 0.5, 40)]], [[jagged(1, 1, 0.6, 25), jagged(1, 1, 0.2, 9)]], [[jagged(-1, 0.3, 0.3, 12)], [jagged(-1, -0.9, 0.07, 5)]],
        [[[(0.5, 0.5), (0.8, 0.5), (0.8, 0.55), (0.5, 0.55), (0.5, 0.5)]]],
    ]
    regs = ingest.with_box(spark.createDataFrame(list(enumerate(shapes)), f"region_name int, parts {rings.PARTS_TYPE}"))
    corners = [p for parts in shapes for part in parts for ring in part for p in ring]
    points = corners + [(round(rng.uniform(-1.5, 2), 2), round(rng.uniform(-1.5, 2), 2)) for _ in range(3000)]
    cases = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "case_id int, lon double, lat double")
    plain = cases.crossJoin(regs).filter(rings.inside_edges(rings.parts_edges(F.col("parts")), F.col("lon"), F.col("lat")))
    assert rows(regions.assign_region(cases, regs), "case_id", "region_name") == rows(plain, "case_id", "region_name")


def test_a_long_border_is_covered_quickly(spark):
    n = 20_000
    ring = [(2.5 * math.cos(2 * math.pi * k / n) * (1 + 0.01 * (k % 7)), 2.5 * math.sin(2 * math.pi * k / n)) for k in range(n)]
    regs = ingest.with_box(spark.createDataFrame([("r", [[ring + ring[:1]]])], f"region_name string, parts {rings.PARTS_TYPE}"))
    start = time.time()
    cover = regions.region_cells(regs)
    assert cover.filter("whole").count() > 6000 and time.time() - start < 30
    assert cover.agg(F.max(F.size("_edges"))).first()[0] < 600


def test_overlapping_regions_and_nulls(spark, small):
    df = spark.createDataFrame(
        [(1, 99.3, 19.6), (2, 100.3270, 13.58), (3, None, 13.6), (4, 0.0, 0.0)], "case_id int, lon double, lat double"
    )
    assert rows(regions.assign_region(df, small["regions"]), "case_id", "region_name") == [
        (1, "Chiang Mai"), (1, "Chiang Rai"), (2, "Bangkok"),
    ]


def test_geohash(spark):
    df = spark.createDataFrame([(100.553, 13.723), (180.0, 90.0), (-180.0, -90.0)], "lon double, lat double")
    key = geohash.cell_key(F.col("lon"), F.col("lat"), 8)
    assert rows(df.select(geohash.cell_text(key, 8).alias("h")), "h") == [("00000000",), ("w4rw04hq",), ("zzzzzzzz",)]
    box = geohash.cell_box(geohash.text_key(F.lit("w4rw04"), 6), 6)
    assert tuple(spark.range(1).select(*box.values()).first()) == (
        100.546875, 13.721923828125, 100.557861328125, 13.7274169921875,
    )


def test_ramp(spark):
    shades = spark.range(1).select(*[ramp_colour(F.lit(v)) for v in (0.0, 0.25, 0.125, 0.5, 1.0, 1.5)]).first()
    assert tuple(shades) == ("#ffffb2", "#fecc5c", "#fee587", "#fd8d3c", "#bd0026", "#bd0026")


def test_csv(spark, tmp_path):
    path = tmp_path / "schools.csv"
    path.write_text("id,name,district,lon,lat\n1,A,D,100.5,13.5\n2,B,D,east,13.5\n")
    bad = str(tmp_path / "bad")
    assert rows(ingest.load_csv(spark, str(path), schemas.SCHOOLS, bad_path=bad), "id", "lon") == [(1, 100.5)]
    assert spark.read.json(bad).count() == 1
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        ingest.load_csv(spark, str(path), schemas.SCHOOLS).collect()


def test_polygons_of_several_rings(spark):
    """Holes and parts: parsed, measured, written, and used as regions."""
    hole = "POLYGON((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 1 3, 2 3, 2 1, 1 1))"
    many = "MULTIPOLYGON(((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 3, 1 3, 1 1)), ((10 0, 11 0, 11 1, 10 1, 10 0)))"
    broken = [
        "POLYGON((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 3))", "MULTIPOLYGON((0 0, 4 0, 4 4, 0 0))", "POLYGON(())", "MULTIPOLYGON()", "POLYGON EMPTY",
    ]
    df = spark.createDataFrame(list(enumerate([hole, many, *broken])), "region_name int, wkt string")
    good, bad = ingest.ingest_wkt(df, "wkt", kind="polygon")
    assert rows(bad, "region_name") == [(2,), (3,), (4,), (5,), (6,)]
    centre = rings.parts_centroid(F.col("parts"))
    measured = good.select("region_name", rings.parts_area(F.col("parts")).alias("a"), F.round(centre["x"] * 30).alias("x"), "x1")
    assert rows(measured, "region_name", "a", "x", "x1") == [(0, 14.0, 62.0, 4.0), (1, 15.0, 79.0, 11.0)]
    text = rows(good.select("region_name", rings.parts_wkt(F.col("parts")).alias("w")), "region_name", "w")
    assert text[0][1].startswith("POLYGON((0.000000000 0.000000000") and text[1][1].startswith("MULTIPOLYGON(((")
    again, _ = ingest.ingest_wkt(good.select("region_name", rings.parts_wkt(F.col("parts")).alias("wkt")), "wkt", kind="polygon")
    assert rows(again, "region_name", "parts") == rows(good, "region_name", "parts")
    points = [(0.5, 0.5), (1.5, 2.0), (1.0, 2.0), (3.0, 3.0), (10.5, 0.5), (5.0, 0.5), (4.0, 4.0)]
    cases = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "case_id int, lon double, lat double")
    found = rows(regions.assign_region(cases, good), "case_id", "region_name")
    assert found == [(0, 0), (0, 1), (2, 0), (2, 1), (3, 0), (3, 1), (4, 1), (6, 0), (6, 1)]
    features_of = features.geojson(features.polygon_features(df.filter("region_name < 2")), features.parts_geometry(), ["region_name"])
    shapes = [json.loads(r["value"])["geometry"] for r in features_of.collect()]
    assert [len(g["coordinates"]) for g in shapes] == [1, 2] and [len(g["coordinates"][0]) for g in shapes] == [2, 2]
    # texts that are no polygon make no feature; `polygon_layer` hands them back
    assert features.polygon_features(df).count() == 2


def test_a_fault_is_no_missing_source(spark, tmp_path):
    """A stored report whose column was renamed stops the load; it is not replaced by the demo layers."""
    spark.range(1).selectExpr("'x' AS text", "1L AS case_count").createOrReplaceTempView("renamed_report")
    load = lambda: ingest.load_tables(spark, "renamed_report", "renamed_report", "renamed_report", "renamed_report")
    with pytest.raises(AnalysisException, match="UNRESOLVED_COLUMN"):
        ingest.first_available(load, lambda: ingest.demo_layers(spark))


def test_tiers_from_a_table(spark, small):
    tiers = spark.createDataFrame([(f"T{k}", k) for k in range(1500)], "risk_tier string, radius_meters int")
    assert zones.cross_tiers(small["cases"].limit(2), tiers).count() == 3000


def test_cells_keep_cases_without_coordinates(spark):
    cases = spark.createDataFrame([(1, None, 13.0), (2, 100.553, 13.723)], "case_id int, lon double, lat double")
    assert rows(heatmap.with_cells(cases), "case_id", "cell_6") == [(1, None), (2, "w4rw04")]


def test_first_available(spark, tmp_path):
    demo = lambda: ingest.demo_layers(spark)
    layers = ingest.first_available(
        lambda: ingest.load_tables(spark, "no_zones", "no_report", "no_hospitals", "no_schools"),
        lambda: ingest.load_csv_exports(spark, str(tmp_path)),
        demo,
    )
    assert {n: d.count() for n, d in layers.items()} == {"hexbin_report": 5, "risk_zones": 9, "hospitals": 15, "schools": 10}
    assert rows(layers["risk_zones"].filter("province_name = 'Bangkok'"), "area_sq_km") == [(0.785,), (3.142,), (12.566,)]
    with pytest.raises(AnalysisException):
        ingest.load_csv_exports(spark, str(tmp_path))
    for name, layer in layers.items():
        layer.toPandas().to_csv(tmp_path / f"{name}.csv", index=False)
    again = ingest.first_available(lambda: ingest.load_csv_exports(spark, str(tmp_path)), demo)
    assert again["risk_zones"].filter("wkt LIKE 'POLYGON%'").count() == 9


def test_features(spark, small, tmp_path):
    layers = ingest.demo_layers(spark)
    polygons = features.polygon_features(layers["risk_zones"])
    styled = features.zone_features(polygons)
    assert rows(styled.select("risk_tier", "colour", "draw_order").distinct(), "risk_tier", "colour", "draw_order") == [
        ("ORANGE", "#e67e22", -1000), ("RED", "#e74c3c", -500), ("YELLOW", "#f1c40f", -2000),
    ]
    other = spark.createDataFrame([("x", 1000), ("y", 7)], "risk_tier string, radius_meters int")
    assert rows(features.zone_features(other, ("#999999", 0.2)), "colour", "opacity") == [("#999999", 0.2), ("#e67e22", 0.3)]
    cells = features.cell_features(features.polygon_features(layers["hexbin_report"]))
    assert rows(cells, "case_count", "intensity")[-1] == (12, 1.0)
    assert rows(features.cell_features(spark.createDataFrame([(0,)], "case_count int")), "intensity") == [(0.0,)]
    points = features.point_features(small["schools"].select("name", "district", "lon", "lat"))
    assert points.first()["popup"].startswith("<b>name:</b> ")
    box = features.extent(small["hospitals"], F.col("lon"), F.col("lat")).first()
    assert tuple(box) == (13.693, 98.958, 20.428, 100.678)
    out = str(tmp_path / "features")
    features.write_features(features.geojson(polygons, features.parts_geometry(), ["risk_tier"]), out)
    lines = [json.loads(r["value"]) for r in spark.read.text(out).collect()]
    assert len(lines) == 9 and lines[0]["geometry"]["type"] == "MultiPolygon" and len(lines[0]["geometry"]["coordinates"][0][0]) == 5


def test_tables(spark, small):
    tables.use_namespace(spark, "surveillance_test")
    try:
        assert tables.create_table(spark, "declared", schemas.SCHOOLS).count() == 0
        for _ in range(2):
            built = build_tables(small["cases"], small["regions"])
            assert {n: d.count() for n, d in built.items()} == {"risk_zones": 9, "cell_report": 21, "cells_in_red_zones": 21}
        assert heatmap.latest_month(built["cell_report"]).count() == 4
        small["hospitals"].write.saveAsTable("hospitals")
        small["schools"].write.saveAsTable("schools")
        layers = ingest.load_tables(spark, "risk_zones", "cell_report", "hospitals", "schools")
        assert {n: d.columns for n, d in layers.items()} == {n: [c.split()[0] for c in s.split(", ")] for n, s in schemas.EXPORTS.items()}
        shown = features.geojson(features.zone_features(features.polygon_features(layers["risk_zones"])), features.parts_geometry(), ["province_name", "colour"])
        shapes = [json.loads(r["value"]) for r in shown.collect()]
        assert len(shapes) == 9 and all(s["geometry"]["coordinates"] and s["properties"]["colour"] for s in shapes)
        areas = features.polygon_features(layers["risk_zones"]).select("area_sq_km", (rings.parts_area(F.col("parts")) * 11988).alias("a"))
        assert all(abs(r["area_sq_km"] - r["a"]) < 0.01 for r in areas.collect())
    finally:
        spark.sql("DROP DATABASE surveillance_test CASCADE")
        spark.catalog.setCurrentDatabase("default")


def test_empty_inputs(spark, small):
    none = small["cases"].limit(0)
    located = regions.assign_region(none, small["regions"])
    assert zones.risk_zones(located).count() == 0
    assert heatmap.cell_report(none).count() == 0


def test_a_failed_write_leaves_the_table(spark):
    tables.use_namespace(spark, "writes_test")
    try:
        tables.write_table(spark.range(5), "kept")
        broken = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("killed")).cast("long")).alias("id"))
        with pytest.raises(Exception, match="killed"):
            tables.write_table(broken, "kept")
        assert rows(spark.table("kept"), "id") == [(i,) for i in range(5)]
        # the query may read what it replaces, and nothing is left behind
        assert tables.write_table(spark.table("kept").filter("id > 2"), "kept").count() == 2
        assert [t.name for t in spark.catalog.listTables()] == ["kept"]
    finally:
        spark.sql("DROP DATABASE writes_test CASCADE")
        spark.catalog.setCurrentDatabase("default")


def test_one_month_is_replaced_alone(spark, small):
    tables.use_namespace(spark, "months_test")
    try:
        tables.write_table(heatmap.cell_report(small["cases"]), "cell_report", partition_by="report_month")
        files = lambda: {r[0]: r[1] for r in spark.table("cell_report").select("report_month", F.input_file_name()).distinct().collect()}
        before, months = files(), sorted(r[0] for r in spark.table("cell_report").select("report_month").distinct().collect())
        later = small["cases"].unionAll(small["cases"].filter(F.trunc("infection_date", "MM") == months[1]))
        refresh_months(later, str(months[1]), str(months[1]))
        after = files()
        assert {m for m in months if after[m] != before[m]} == {months[1]}
        wanted = heatmap.cell_report(later)
        assert rows(spark.table("cell_report"), *sorted(wanted.columns)) == rows(wanted, *sorted(wanted.columns))
        with pytest.raises(ValueError):
            tables.replace_partitions(wanted.drop("wkt"), "cell_report", "report_month")
    finally:
        spark.sql("DROP DATABASE months_test CASCADE")
        spark.catalog.setCurrentDatabase("default")


def test_bad_polygon_texts_are_skipped(spark):
    data = [(1, "POLYGON((0 0, 1 0, 1 1, 0 0))"), (2, "POLYGON((0 0, 1 0"), (3, None), (4, ""), (5, "MULTIPOLYGON(((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))")]
    df = spark.createDataFrame(data, "id int, wkt string")
    layer, rejects = features.polygon_layer(df)
    assert rows(layer, "id", "tooltip") == [(1, "id: 1"), (5, "id: 5")] and sorted(map(tuple, rejects.collect())) == [(2, "POLYGON((0 0, 1 0"), (3, None), (4, "")]
    assert rows(features.polygon_features(df), "id") == [(1,), (5,)]
    assert tuple(features.parts_extent(layer).first()) == (0.0, 0.0, 6.0, 6.0)

"""The questions as queries over the bound tables: name -> (spark, data folder) -> DataFrame."""

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from epigrid.constants import SEVERE
from epigrid.functions.geo import dist_deg, is_severe, round_half_up, to_degrees, to_metres
from epigrid.functions.geohash import cell_text
from epigrid.functions.hexgrid import hex_ring, hex_text
from epigrid.functions.projection import LON_LAT, UTM_NORTH, from_utm, reproject_parts, to_utm
from epigrid.functions.ring_text import ring_texts
from epigrid.functions.rings import (
    number_text, parts_area, parts_centroid, parts_wkt, point_wkt, ring_area, ring_wkt,
)
from epigrid.operators import counting, features, heatmap, hexmap, proximity, regions, scoring, zones
from epigrid.plans import batch
from epigrid.session import cut_lineage, tune
from epigrid.sources import binding, ingest, tables

# The reference points of the distance and nearest-to-point questions.
CITY_POINT = (100.4856, 13.7590)
ONE_CASE, ONE_REGION = 42, "NATION_17"
REGIONAL_METRES = (25_000, 50_000, 100_000)
CLUSTER_POINTS = ((100.554, 13.723), (100.55, 13.72))
# The UTM zone of the country's capital; a plane of metres for distances and areas across zones.
HOME_ZONE = 47


@dataclass
class Inputs:
    """The bound tables of one data folder."""

    spark: SparkSession
    folder: str

    @cached_property
    def cases(self) -> DataFrame:
        return binding.cases(self.spark, self.folder)

    @cached_property
    def schools(self) -> DataFrame:
        return binding.schools(self.spark, self.folder)

    @cached_property
    def hospitals(self) -> DataFrame:
        return binding.hospitals(self.spark, self.folder)

    @cached_property
    def regions(self) -> DataFrame:
        return binding.regions(self.spark, self.folder)

    @cached_property
    def areas(self) -> DataFrame:
        return binding.areas(self.spark, self.folder)

    @cached_property
    def in_areas(self) -> DataFrame:
        """Cases with every row of the areas that holds them."""
        return regions.assign_region(self.cases, self.areas).drop("parts")

    @cached_property
    def located(self) -> DataFrame:
        """Cases with every region that holds them."""
        return regions.assign_region(self.cases, self.regions).drop("ring")


def row_counts(t: Inputs) -> DataFrame:
    return tables.row_counts(
        {"cases": t.cases, "hospitals": t.hospitals, "regions": t.regions, "schools": t.schools}
    )


def cases_near_schools(t: Inputs) -> DataFrame:
    return scoring.case_load(t.schools, t.cases, 1000, severe=("DHF",))


def severe_cases_near_schools(t: Inputs) -> DataFrame:
    return scoring.case_load(t.schools, t.cases, 1000)


def distance_to_city(t: Inputs) -> DataFrame:
    away = dist_deg("lon", "lat", *CITY_POINT)
    return t.schools.select(
        "id",
        round_half_up(away, 4).alias("distance_degrees"),
        round_half_up(to_metres(away)).alias("approx_meters"),
    )


def nearest_hospital(t: Inputs) -> DataFrame:
    cases = t.cases.select("case_id", "patient_age", "severity", "lon", "lat")
    nearest = proximity.nearest_facility(cases, t.hospitals, carry=("name",))
    return nearest.select(
        "case_id", "patient_age", "severity", F.col("name").alias("nearest_hospital"),
        round_half_up(to_metres("dist_deg")).alias("distance_meters"),
    )


def hospital_case_load(t: Inputs) -> DataFrame:
    # A left join that keeps only facilities with a case is an inner join.
    load = scoring.case_load(t.hospitals, t.cases, 5000, by=("name", "province"))
    return load.drop("nearest_case_meters")


def hospital_case_load_all(t: Inputs) -> DataFrame:
    near = counting.ring_counts(t.hospitals, t.cases, [5000], nearest=False)
    load = near.groupBy("id").agg(F.sum("_n").alias("_n"))
    counted = t.hospitals.select("id", "name", "province").join(load, "id", "left")
    return counted.groupBy("name", "province").agg(F.sum(F.coalesce("_n", F.lit(0))).alias("case_count"))


def regional_case_load(t: Inputs) -> DataFrame:
    """Cases within 25, 50 and 100 km of every hospital, those that are severe, and the nearest."""
    near = counting.ring_counts(t.hospitals, t.cases, list(REGIONAL_METRES), by=("severity",))
    within = [
        F.sum(F.when(F.col("_ring") <= k, F.col("_n")).otherwise(0)).alias(f"cases_{metres // 1000}_km")
        for k, metres in enumerate(REGIONAL_METRES)
    ]
    severe = F.sum(F.when(is_severe("severity", SEVERE), F.col("_n")).otherwise(0)).alias("severe_cases")
    nearest = round_half_up(to_metres(F.min("_near"))).alias("nearest_case_meters")
    return near.groupBy("id", "name").agg(*within, severe, nearest)


def hospitals_nearest_points(t: Inputs) -> DataFrame:
    found = None
    for number, (lon, lat) in enumerate(CLUSTER_POINTS, 1):
        nearest = proximity.nearest_to_point(t.hospitals, lon, lat, 3).select(
            F.lit(number).alias("point"), "id", "name", round_half_up(to_metres("dist_deg")).alias("distance_meters")
        )
        found = nearest if found is None else found.unionByName(nearest)
    return found


def case_buffer(t: Inputs) -> DataFrame:
    return zones.case_buffers(t.cases, 500).select("case_id", "severity", ring_wkt(F.col("ring")).alias("buffer_500m_wkt"))


def tier_buffers(t: Inputs) -> DataFrame:
    return zones.tier_buffers(t.cases).select(
        "case_id",
        "severity",
        "infection_date",
        "risk_tier",
        "radius_meters",
        ring_texts(F.col("ring")).alias("zone_wkt"),
    )


def school_case_tiers(t: Inputs) -> DataFrame:
    pairs = scoring.tiered_pairs(t.schools, t.cases)
    return pairs.select("name", "district", "case_id", "severity", "distance_meters", "risk_tier")


def school_threat(t: Inputs) -> DataFrame:
    return scoring.case_load(t.schools, t.cases, 2000)


def school_cumulative_tiers(t: Inputs) -> DataFrame:
    return scoring.cumulative_tiers(t.schools, t.cases)


def merged_outline(t: Inputs) -> DataFrame:
    red = zones.tiers_of(t.located.select("region_name", "lon", "lat"), zones.RISK_TIERS[:1])
    pieces = zones.outline(red, ["region_name"])
    return pieces.select(
        "region_name",
        "k",
        *[round_half_up(F.col(c), 6).alias(c) for c in ("lon", "lat", "from_x", "from_y", "to_x", "to_y")],
    )


def _red_rings(t: Inputs) -> DataFrame:
    red = zones.tiers_of(t.located.select("region_name", "lon", "lat"), zones.RISK_TIERS[:1])
    return zones.rings(red, ["region_name"])


def merged_rings(t: Inputs) -> DataFrame:
    """The closed rings of each region's merged RED zone, added up: vertices, and area with holes taken off."""
    summary = zones.ring_summary(_red_rings(t), ["region_name"])
    return summary.groupBy("region_name").agg(
        F.sum("vertices").alias("vertices"),
        round_half_up(F.sum("area_deg2") * F.lit(zones.SQKM_PER_SQDEG), 3).alias("area_sq_km"),
    )


def merged_wkt(t: Inputs) -> DataFrame:
    return zones.ring_texts(_red_rings(t), ["region_name"]).select("region_name", "wkt")


def merged_areas(t: Inputs) -> DataFrame:
    return zones.wide_areas(zones.risk_zones(t.located))


def overlap_savings(t: Inputs) -> DataFrame:
    return zones.risk_zones(t.located).select(
        "region_name", "risk_tier", "naive_sq_km", F.col("area_sq_km").alias("merged_sq_km"), "overlap_savings_pct"
    )


def risk_zones(t: Inputs) -> DataFrame:
    return zones.risk_zones(t.located).select("region_name", "risk_tier", "radius_meters", "case_count", "area_sq_km")


def severity_score(t: Inputs) -> DataFrame:
    return scoring.severity_score(t.schools, t.cases)


def fogging_score(t: Inputs) -> DataFrame:
    return scoring.fogging_score(t.schools, t.cases).drop("red_cases")


def fogging_top(t: Inputs) -> DataFrame:
    scores = scoring.fogging_score(t.schools, t.cases)
    return scores.orderBy(F.desc("risk_score"), F.desc("case_count"), "name").limit(3).drop("red_cases")


def fogging_summary(t: Inputs) -> DataFrame:
    return scoring.fogging_summary(scoring.fogging_score(t.schools, t.cases))


def case_cells(t: Inputs) -> DataFrame:
    return heatmap.with_cells(t.cases).select("case_id", "cell_5", "cell_6", "cell_7")


def cell_heatmap(t: Inputs) -> DataFrame:
    return heatmap.cell_heatmap(t.cases)


def cell_polygons(t: Inputs) -> DataFrame:
    return heatmap.cell_heatmap(t.cases, polygons=True).drop("outbreak_duration_days")


def resolution_counts(t: Inputs) -> DataFrame:
    labels = {5: "Precision 5 (province)", 6: "Precision 6 (city)", 7: "Precision 7 (neighborhood)"}
    return heatmap.resolution_counts(t.cases, labels)


def monthly_cells(t: Inputs) -> DataFrame:
    return heatmap.monthly_cells(t.cases)


def cell_report(t: Inputs) -> DataFrame:
    return heatmap.cell_report(t.cases)


def report_readback(t: Inputs) -> DataFrame:
    report = heatmap.cell_report(t.cases)
    ordered = report.withColumn("severe_count", F.col("dhf_count") + F.col("dss_count")).orderBy(
        "report_month", F.desc("case_count"), "cell_id"
    )
    return ordered.select("report_month", "cell_id", "case_count", "severe_count", "avg_age").limit(30)


def cells_in_red_zones(t: Inputs) -> DataFrame:
    # read twice below
    located = cut_lineage(t.located.select("region_name", "lon", "lat").distinct(), "located")
    touched = heatmap.touched_cells(located, to_degrees(F.lit(500.0)), ["region_name"])
    return batch.red_zone_overlay(heatmap.monthly_cells(t.cases, polygons=False), touched, batch.red_zones(located))


def region_resolutions(t: Inputs) -> DataFrame:
    return heatmap.compare_resolutions(t.located, by=("region_name",))


def region_heatmap(t: Inputs) -> DataFrame:
    cells = heatmap.cell_heatmap(t.located, polygons=True, by=("region_name",))
    return cells.select("region_name", "cell_id", "case_count", F.col("cell_polygon_wkt").alias("wkt"))


def monthly_trend(t: Inputs) -> DataFrame:
    return heatmap.monthly_trend(t.cases)


def month_change(t: Inputs) -> DataFrame:
    return heatmap.month_change(t.cases)


def sharpest_change(t: Inputs) -> DataFrame:
    return heatmap.month_change(t.cases).orderBy(F.desc("month_change"), "cell_id", "report_month").limit(5)


def latest_month(t: Inputs) -> DataFrame:
    return heatmap.latest_month_report(t.cases).select("report_month", "wkt", "case_count")


def fine_heatmap(t: Inputs) -> DataFrame:
    cells = heatmap.cell_heatmap(t.cases, precision=7, polygons=True)
    return cells.select("cell_id", "case_count", "severe_count", "cell_polygon_wkt")


def hottest_cell(t: Inputs) -> DataFrame:
    return fine_heatmap(t).orderBy(F.desc("case_count"), "cell_id").limit(1)


def severity_mix(t: Inputs) -> DataFrame:
    return heatmap.severity_mix(t.cases)


def case_labels(t: Inputs) -> DataFrame:
    return t.cases.select(
        F.concat(F.lit("Case "), F.col("case_id").cast("string")).alias("label"), "severity", "patient_age", "lat", "lon"
    )


def facility_points(t: Inputs) -> DataFrame:
    hospitals = t.hospitals.select("name", F.col("province").alias("area"), "lat", "lon")
    schools = t.schools.select("name", F.col("district").alias("area"), "lat", "lon")
    return hospitals.withColumn("kind", F.lit("hospital")).unionByName(schools.withColumn("kind", F.lit("school")))


def point_features(t: Inputs) -> DataFrame:
    shown = t.hospitals.select("name", "province", "lon", "lat")
    return features.point_features(shown, popup_cols=["name", "province"]).select("label", "popup", "lon", "lat")


def zone_features(t: Inputs) -> DataFrame:
    counts = t.located.groupBy("region_name").agg(F.countDistinct("case_id").alias("case_count"))
    zoned = zones.tiers_of(counts).select("region_name", "risk_tier", "radius_meters", "case_count")
    styled = features.zone_features(zoned)
    return styled.select("region_name", "risk_tier", "colour", "opacity", "draw_order", "tooltip")


def cell_features(t: Inputs) -> DataFrame:
    cells = heatmap.cell_heatmap(t.cases).select("cell_id", "case_count", "severe_count")
    return features.cell_features(cells).withColumn("intensity", round_half_up(F.col("intensity"), 6))


def layer_extents(t: Inputs) -> DataFrame:
    cells = heatmap.with_key(t.cases, 6).select("_cell").distinct()
    layers = {
        "cells": features.ring_extent(heatmap.cell_rings(cells, 6)),
        "hospitals": features.extent(t.hospitals, F.col("lon"), F.col("lat")),
        "schools": features.extent(t.schools, F.col("lon"), F.col("lat")),
    }
    result = None
    for name, box in layers.items():
        rounded = box.select(F.lit(name).alias("layer"), *[round_half_up(F.col(c), 5).alias(c) for c in box.columns])
        result = rounded if result is None else result.unionByName(rounded)
    return result


def geojson_points(t: Inputs) -> DataFrame:
    return features.geojson_text(t.schools, "Point", features.position_text(F.col("lon"), F.col("lat")), ["id", "name"])


def geojson_cells(t: Inputs) -> DataFrame:
    """The heatmap's cells with their rectangle and case counts."""
    counted = heatmap.with_key(t.cases, 6).groupBy("_cell").agg(F.count(F.lit(1)).alias("case_count"))
    named = heatmap.cell_rings(counted.withColumn("cell_id", cell_text(F.col("_cell"), 6)), 6)
    return features.geojson_text(named, "Polygon", features.ring_text(), ["cell_id", "case_count"])


def one_case_buffer(t: Inputs) -> DataFrame:
    """The buffer of one case; the filter reaches the scan."""
    return case_buffer(Inputs(t.spark, t.folder)).filter(F.col("case_id") == ONE_CASE)


def one_region_heatmap(t: Inputs) -> DataFrame:
    """The heatmap of one region; the filter reaches the scan of the regions."""
    located = regions.assign_region(t.cases, t.regions.filter(F.col("region_name") == ONE_REGION)).drop("ring")
    cells = heatmap.cell_heatmap(located, polygons=True)
    return cells.select("cell_id", "case_count", F.col("cell_polygon_wkt").alias("wkt"))


def zone_readback(t: Inputs) -> DataFrame:
    """The risk zones sorted by their radius, which is not shown."""
    ordered = risk_zones(t).orderBy("region_name", "radius_meters")
    return ordered.select("region_name", "risk_tier", "case_count", "area_sq_km")


def wkt_points(t: Inputs) -> DataFrame:
    """Points written as text and read again."""
    texts = t.cases.select("case_id", point_wkt(F.col("lon"), F.col("lat")).alias("wkt"))
    parsed, _ = ingest.ingest_wkt(texts, "wkt")
    return parsed.select("case_id", number_text(F.col("lon")).alias("lon"), number_text(F.col("lat")).alias("lat"))


def wkt_polygons(t: Inputs) -> DataFrame:
    texts = t.regions.select("region_code", ring_wkt(F.col("ring")).alias("wkt"))
    parsed, _ = ingest.ingest_wkt(texts, "wkt", kind="polygon")
    return parsed.select(
        "region_code",
        *[round_half_up(F.col(c), 4).alias(c) for c in ("x0", "y0", "x1", "y1")],
        round_half_up(ring_area(F.col("ring")), 4).alias("area"),
    )


def wkt_rejects(t: Inputs) -> DataFrame:
    """Event texts are no point texts, so each of them is a reject."""
    raw = t.spark.read.parquet(f"{t.folder}/events.parquet").select("event_id", F.col("props").alias("wkt"))
    _, rejects = ingest.ingest_wkt(raw, "wkt")
    return rejects.select("event_id", "wkt")


def wkt_mixed_points(t: Inputs) -> DataFrame:
    """Good and bad point texts made from the events: every row is either accepted with its coordinates or a reject."""
    x, y, turn = number_text(F.col("lon")), number_text(F.col("lat")), F.col("case_id") % 5
    text = (
        F.when(turn == 0, F.concat(F.lit("POINT("), x, F.lit(" "), y, F.lit(")")))
        .when(turn == 1, F.concat(F.lit("  point ( "), x, F.lit("  "), y, F.lit(" ) ")))
        .when(turn == 2, F.concat(F.lit("POINT("), x, F.lit(")")))
        .when(turn == 3, F.concat(F.lit("POINT("), x, F.lit(" "), y, F.lit(") "), F.col("severity")))
    )
    good, bad = ingest.ingest_wkt(t.cases.select("case_id", text.alias("wkt")), "wkt")
    shown = good.select("case_id", F.lit(True).alias("accepted"), number_text(F.col("lon")).alias("lon"), number_text(F.col("lat")).alias("lat"))
    return shown.unionByName(bad.select("case_id", F.lit(False).alias("accepted")), allowMissingColumns=True)


def wkt_mixed_polygons(t: Inputs) -> DataFrame:
    """Polygon texts with one ring, a hole, two parts, and an open ring, made from the region boxes."""
    key = F.col("region_code").cast("int")
    x, y = F.col("x0").cast("int"), F.col("y0").cast("int")

    def box(x0, y0, x1, y1, closed=True):
        corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)] + [(x0, y0)] * closed
        pairs = [F.concat(a.cast("string"), F.lit(" "), b.cast("string")) for a, b in corners]
        return F.concat(F.lit("("), F.concat_ws(", ", *pairs), F.lit(")"))

    outer, hole, far = box(x, y, x + 4, y + 4), box(x + 1, y + 1, x + 2, y + 3), box(x + 10, y, x + 11, y + 1)
    text = (
        F.when(key % 4 == 0, F.concat(F.lit("POLYGON("), outer, F.lit(")")))
        .when(key % 4 == 1, F.concat(F.lit("POLYGON("), outer, F.lit(", "), hole, F.lit(")")))
        .when(key % 4 == 2, F.concat(F.lit("MULTIPOLYGON(("), outer, F.lit(", "), hole, F.lit("), ("), far, F.lit("))")))
        .otherwise(F.concat(F.lit("POLYGON("), box(x, y, x + 4, y + 4, closed=False), F.lit(")")))
    )
    good, bad = ingest.ingest_wkt(t.regions.select("region_code", text.alias("wkt")), "wkt", kind="polygon")
    centre = parts_centroid(F.col("parts"))
    shown = good.select(
        "region_code", F.lit(True).alias("accepted"), round_half_up(parts_area(F.col("parts")), 4).alias("area"),
        round_half_up(centre["x"], 6).alias("cx"), round_half_up(centre["y"], 6).alias("cy"), parts_wkt(F.col("parts")).alias("wkt"),
    )
    return shown.unionByName(bad.select("region_code", F.lit(False).alias("accepted")), allowMissingColumns=True)


def repeated_names(t: Inputs) -> DataFrame:
    return tables.duplicate_keys(t.schools, ["district"])


def region_assignment(t: Inputs) -> DataFrame:
    return t.located.select("case_id", "region_name")


def area_assignment(t: Inputs) -> DataFrame:
    return t.in_areas.select("case_id", "region_name")


def area_resolutions(t: Inputs) -> DataFrame:
    return heatmap.compare_resolutions(t.in_areas, by=("region_name",))


def area_heatmap(t: Inputs) -> DataFrame:
    cells = heatmap.cell_heatmap(t.in_areas, polygons=True, by=("region_name",))
    return cells.select("region_name", "cell_id", "case_count", F.col("cell_polygon_wkt").alias("wkt"))


def utm_cases(t: Inputs) -> DataFrame:
    """Every case in metres of its own zone, to the centimetre."""
    metres = [round_half_up(F.col(c), 2).alias(c) for c in ("easting", "northing")]
    return to_utm(t.cases).select("case_id", "utm_zone", "utm_north", *metres)


def utm_round_trip(t: Inputs) -> DataFrame:
    """Per zone: its cases, and how many come back from metres to less than a millimetre."""
    back = from_utm(to_utm(t.cases), "lon2", "lat2")
    off = F.greatest(F.abs(F.col("lon2") - F.col("lon")), F.abs(F.col("lat2") - F.col("lat"))) * F.lit(111_320.0)
    return back.groupBy("utm_zone").agg(F.count(F.lit(1)).alias("cases"), scoring.count_if(off < 0.001).alias("within_1_mm"))


def utm_distance_to_city(t: Inputs) -> DataFrame:
    """Distance of every school to the city in metres of one zone, beside the planar estimate."""
    city = t.schools.limit(1).select(F.lit(CITY_POINT[0]).alias("lon"), F.lit(CITY_POINT[1]).alias("lat"))
    city = to_utm(city, zone=HOME_ZONE).select(F.col("easting").alias("_e"), F.col("northing").alias("_n"))
    # one row against every school
    east, north = (F.col(c) - city.select(f).scalar() for c, f in (("easting", "_e"), ("northing", "_n")))
    estimate = to_metres(dist_deg("lon", "lat", *CITY_POINT))
    return to_utm(t.schools, zone=HOME_ZONE).select(
        "id", round_half_up(F.sqrt(east * east + north * north), 2).alias("utm_meters"), round_half_up(estimate).alias("approx_meters")
    )


def utm_area_sizes(t: Inputs) -> DataFrame:
    """Area of every area's geometry in square kilometres of one zone, holes left out."""
    parts = reproject_parts(F.col("parts"), LON_LAT, UTM_NORTH + HOME_ZONE)
    return t.areas.select("region_name", round_half_up(parts_area(parts) / 1e6, 3).alias("area_sq_km"))


def hex_heatmap(t: Inputs) -> DataFrame:
    cells = hexmap.hex_heatmap(t.cases)
    return cells.select("hex_id", "case_count", "severe_count", ring_wkt(F.col("ring")).alias("wkt"))


def hex_rollup(t: Inputs) -> DataFrame:
    rolled = hexmap.hex_rollup(hexmap.hex_counts(t.cases), factor=3)
    ring = hex_ring(F.col("_hex"), 3 * hexmap.HEX_SIZE)
    return rolled.select(hex_text(F.col("_hex")).alias("hex_id"), "cells", "case_count", "severe_count", ring_wkt(ring).alias("wkt"))


def hex_neighbourhood(t: Inputs) -> DataFrame:
    around = hexmap.hex_neighbourhood(hexmap.hex_counts(t.cases), reach=2)
    return around.select(hex_text(F.col("_hex")).alias("hex_id"), "case_count", "nearby_count")


def hex_regions(t: Inputs) -> DataFrame:
    """Hexagons of every region, with a cell's share of the region's cases in per mille."""
    cells = hexmap.hex_counts(t.located, by=("region_name",))
    whole = cells.groupBy("region_name").agg(F.sum("case_count").alias("_all"))
    share = round_half_up(F.lit(1000.0) * F.col("case_count") / F.col("_all"), 3)
    return cells.join(whole, "region_name").select("region_name", hex_text(F.col("_hex")).alias("hex_id"), "case_count", share.alias("per_mille"))


def _red_zone_layer(t: Inputs) -> DataFrame:
    """The merged RED zones as map features: geometry `parts`, cases, style."""
    located = cut_lineage(t.located.select("region_name", "case_id", "lon", "lat"), "located")
    red = zones.tiers_of(located.select("region_name", "lon", "lat").distinct(), zones.RISK_TIERS[:1])
    shapes = zones.zone_parts(zones.rings(red, ["region_name"]), ["region_name"])
    counts = located.groupBy("region_name").agg(F.countDistinct("case_id").alias("case_count"))
    named = shapes.join(counts, "region_name").withColumn("risk_tier", F.lit("RED"))
    return features.zone_features(named.select("region_name", "risk_tier", "radius_meters", "case_count", "parts"))


def zone_layer(t: Inputs) -> DataFrame:
    """The zone layer with geometry: its style, the vertices of all rings and the area less its holes."""
    corners = F.aggregate(F.flatten("parts"), F.lit(0).cast("bigint"), lambda n, r: n + F.size(r) - 1)
    return _red_zone_layer(t).select(
        "region_name", "colour", "opacity", "draw_order", "tooltip", corners.alias("vertices"),
        round_half_up(parts_area(F.col("parts")) * F.lit(zones.SQKM_PER_SQDEG), 3).alias("area_sq_km"),
    )


def zone_extent(t: Inputs) -> DataFrame:
    """The smallest box around the zone layer."""
    box = features.parts_extent(_red_zone_layer(t))
    return box.select(*[round_half_up(F.col(c), 5).alias(c) for c in box.columns])


def polygon_layer(t: Inputs) -> DataFrame:
    """Polygon features from texts good and bad: accepted ones with parts and tooltip, the others as rejects."""
    key = F.col("region_code").cast("int")
    text = F.when(key % 3 == 0, F.lit("POLYGON((1 2, oops))")).when(key % 3 == 1, ring_wkt(F.col("ring")))
    layer, rejects = features.polygon_layer(t.regions.select("region_code", "region_name", text.alias("wkt")))
    shown = layer.select("region_code", F.lit(True).alias("accepted"), "tooltip", F.size("parts").alias("parts"))
    refused = rejects.select("region_code", F.lit(False).alias("accepted"), F.lit(0).alias("parts"))
    return shown.unionByName(refused, allowMissingColumns=True)


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    "q01_row_counts": row_counts,
    "q02_cases_near_schools": cases_near_schools,
    "q02_severe_cases_near_schools": severe_cases_near_schools,
    "q03_distance_to_city": distance_to_city,
    "q04_nearest_hospital": nearest_hospital,
    "q05_hospital_case_load": hospital_case_load,
    "q05_hospital_case_load_all": hospital_case_load_all,
    "q05_regional_case_load": regional_case_load,
    "q06_hospitals_nearest_points": hospitals_nearest_points,
    "q07_case_buffer": case_buffer,
    "q08_tier_buffers": tier_buffers,
    "q09_school_case_tiers": school_case_tiers,
    "q10_school_threat": school_threat,
    "q11_school_cumulative_tiers": school_cumulative_tiers,
    "q12_merged_outline": merged_outline,
    "q12_merged_rings": merged_rings,
    "q12_merged_wkt": merged_wkt,
    "q13_merged_areas": merged_areas,
    "q14_overlap_savings": overlap_savings,
    "q15_risk_zones": risk_zones,
    "q16_severity_score": severity_score,
    "q17_fogging_score": fogging_score,
    "q17_fogging_top": fogging_top,
    "q17_fogging_summary": fogging_summary,
    "q18_case_cells": case_cells,
    "q19_cell_heatmap": cell_heatmap,
    "q20_cell_polygons": cell_polygons,
    "q21_resolution_counts": resolution_counts,
    "q22_monthly_cells": monthly_cells,
    "q23_cell_report": cell_report,
    "q23_report_readback": report_readback,
    "q24_cells_in_red_zones": cells_in_red_zones,
    "q25_region_resolutions": region_resolutions,
    "q26_region_heatmap": region_heatmap,
    "q27_monthly_trend": monthly_trend,
    "q28_month_change": month_change,
    "q28_sharpest_change": sharpest_change,
    "q29_latest_month": latest_month,
    "q30_fine_heatmap": fine_heatmap,
    "q30_hottest_cell": hottest_cell,
    "q31_severity_mix": severity_mix,
    "q32_case_labels": case_labels,
    "q33_facility_points": facility_points,
    "q34_point_features": point_features,
    "q34_zone_features": zone_features,
    "q34_cell_features": cell_features,
    "q34_layer_extents": layer_extents,
    "geojson_points": geojson_points,
    "geojson_cells": geojson_cells,
    "q07_one_case_buffer": one_case_buffer,
    "q26_one_region_heatmap": one_region_heatmap,
    "q15_zone_readback": zone_readback,
    "wkt_mixed_points": wkt_mixed_points,
    "wkt_mixed_polygons": wkt_mixed_polygons,
    "wkt_points": wkt_points,
    "wkt_polygons": wkt_polygons,
    "wkt_rejects": wkt_rejects,
    "repeated_names": repeated_names,
    "region_assignment": region_assignment,
    "area_assignment": area_assignment,
    "q25_area_resolutions": area_resolutions,
    "q26_area_heatmap": area_heatmap,
    "utm_cases": utm_cases,
    "utm_round_trip": utm_round_trip,
    "utm_distance_to_city": utm_distance_to_city,
    "utm_area_sizes": utm_area_sizes,
    "hex_heatmap": hex_heatmap,
    "hex_rollup": hex_rollup,
    "hex_neighbourhood": hex_neighbourhood,
    "hex_regions": hex_regions,
    "q34_zone_layer": zone_layer,
    "q34_zone_extent": zone_extent,
    "q34_polygon_layer": polygon_layer,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(question):
        return lambda spark, folder: question(Inputs(tune(spark), folder))

    return {name: bind(question) for name, question in QUERIES.items()}

"""Known answers on the small fixture."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows
from epigrid.functions.geo import dist_deg, round_half_up, to_metres
from epigrid.operators import heatmap, proximity, scoring, zones
from epigrid.sources.tables import duplicate_keys, row_counts


def test_row_counts(small):
    named = {n: small[n] for n in ("hospitals", "cases", "schools", "regions")}
    assert rows(row_counts(named), "table_name", "row_count") == [
        ("cases", 30), ("hospitals", 15), ("regions", 3), ("schools", 10),
    ]


def test_cases_near_schools(small):
    only_dhf = scoring.case_load(small["schools"], small["cases"], 1000, severe=("DHF",))
    assert rows(only_dhf, "name", "case_count", "severe_count", "nearest_case_meters") == [
        ("Din Daeng Wittaya School", 8, 2, 248),
        ("Khlong Toei Wittaya School", 12, 3, 277),
        ("Ratchadaphisek Wittayalai School", 7, 2, 248),
        ("Sukhumvit Pattana School", 5, 0, 869),
        ("Wat Khlong Toei School", 12, 3, 124),
    ]
    both = scoring.case_load(small["schools"], small["cases"], 1000)
    assert rows(both, "severe_count") == [(1,), (3,), (3,), (4,), (4,)]


def test_two_constant_points(spark):
    d = dist_deg(F.lit(100.4856), F.lit(13.7590), F.lit(98.9720), F.lit(18.7880))
    row = spark.range(1).select(round_half_up(d, 4).alias("deg"), round_half_up(to_metres(d)).alias("m")).first()
    assert (row["deg"], row["m"]) == (5.2518, 582954)


def test_nearest_hospital(small):
    nearest = proximity.nearest_facility(small["cases"], small["hospitals"]).withColumn(
        "m", round_half_up(to_metres("dist_deg"))
    )
    found = {r["case_id"]: (r["facility_id"], r["m"]) for r in nearest.collect()}
    assert len(found) == 30
    assert found[11] == (3, 3070) and found[4] == (3, 2870) and found[7] == (3, 2822) and found[18] == (2, 2644)
    assert all(found[i][0] == 3 for i in range(1, 13)) and all(found[i][0] == 2 for i in range(13, 21))
    assert [found[i] for i in (21, 22, 23, 24, 25, 26)] == [(10, 785), (9, 702), (10, 808), (9, 888), (10, 800), (10, 745)]
    assert [found[i] for i in (27, 28, 29, 30)] == [(15, 496), (15, 496), (15, 666), (15, 471)]


def test_hospital_case_load(small):
    load = scoring.case_load(small["hospitals"], small["cases"], 5000, by=("name", "province"))
    assert rows(load, "name", "case_count", "severe_count") == [
        ("Chiang Mai Ram Hospital", 6, 2),
        ("King Chulalongkorn Memorial", 20, 7),
        ("Mae Sai Hospital", 4, 1),
        ("Maharaj Nakorn Chiang Mai", 6, 2),
        ("Queen Sirikit National Institute", 9, 3),
        ("Ramathibodi Hospital", 15, 5),
    ]
    everyone = proximity.within_distance(small["hospitals"], small["cases"], 5000, how="left")
    counts = everyone.groupBy("name").agg(F.count("case_id").alias("n"))
    assert counts.count() == 15 and counts.filter("n = 0").count() == 9


def test_nearest_to_point(small):
    def nearest(lon, lat):
        found = proximity.nearest_to_point(small["hospitals"], lon, lat, 3)
        return [tuple(r) for r in found.select("id", round_half_up(to_metres("dist_deg"))).collect()]

    assert nearest(100.55, 13.72) == [(3, 2105), (2, 5145), (7, 5542)]
    assert nearest(100.554, 13.723) == [(3, 2328), (2, 4959), (5, 5466)]


def test_threat_and_tiers(small):
    pairs = scoring.tiered_pairs(small["schools"], small["cases"])
    assert pairs.count() == 60
    assert {r[0] for r in pairs.select("risk_tier").distinct().collect()} == set(scoring.TIER_LABELS.values())
    threat = scoring.case_load(small["schools"], small["cases"], 2000)
    assert rows(threat, "name", "case_count", "severe_count", "nearest_case_meters")[2] == ("Khlong Toei Wittaya School", 12, 4, 277)
    tiers = scoring.cumulative_tiers(small["schools"], small["cases"])
    assert rows(tiers, "name", "threatening_cases", "red_cases", "orange_cases", "yellow_cases") == [
        ("Din Daeng Wittaya School", 8, 6, 8, 8),
        ("Huai Khwang School", 8, 0, 0, 8),
        ("Khlong Toei Wittaya School", 12, 3, 12, 12),
        ("Ratchadaphisek Wittayalai School", 8, 2, 7, 8),
        ("Sukhumvit Pattana School", 12, 0, 5, 12),
        ("Wat Khlong Toei School", 12, 10, 12, 12),
    ]


def test_scores(small):
    scores = scoring.severity_score(small["schools"], small["cases"])
    assert scores.count() == 10
    positive = scores.filter("total_risk_score > 0")
    assert rows(positive, "total_risk_score", "dss_cases", "dhf_cases", "df_cases") == [
        (5, 0, 0, 5), (8, 0, 0, 8), (9, 0, 2, 5), (12, 1, 2, 5), (14, 0, 3, 8), (17, 1, 3, 8),
    ]
    fogging = scoring.fogging_score(small["schools"], small["cases"])
    assert rows(fogging, "risk_score", "case_count") == [(11, 8), (22, 12), (24, 8), (30, 8), (36, 12), (46, 12)]
    assert tuple(scoring.fogging_summary(fogging).first()) == (6, 28.17, 4)


def test_zone_areas(located):
    found = rows(zones.risk_zones(located), "region_name", "radius_meters", "case_count", "naive_sq_km", "area_sq_km", "overlap_savings_pct")
    assert found == [
        ("Bangkok", 500, 20, 15.185, 3.963, 73.9),
        ("Bangkok", 1000, 20, 60.742, 10.702, 82.4),
        ("Bangkok", 2000, 20, 242.967, 33.245, 86.3),
        ("Chiang Mai", 500, 6, 4.556, 1.745, 61.7),
        ("Chiang Mai", 1000, 6, 18.222, 4.981, 72.7),
        ("Chiang Mai", 2000, 6, 72.890, 15.983, 78.1),
        ("Chiang Rai", 500, 4, 3.037, 1.362, 55.2),
        ("Chiang Rai", 1000, 4, 12.148, 4.252, 65.0),
        ("Chiang Rai", 2000, 4, 48.593, 14.585, 70.0),
    ]


def test_cell_heatmap(small):
    found = rows(heatmap.cell_heatmap(small["cases"]), "cell_id", "case_count", "severe_count", "outbreak_duration_days")
    assert found == [
        ("w4rw01", 3, 2, 44), ("w4rw03", 2, 0, 40), ("w4rw04", 7, 2, 61), ("w4rw21", 1, 1, 0), ("w4rw23", 6, 2, 53),
        ("w4rw24", 1, 0, 0), ("w5q6u7", 2, 1, 24), ("w5q6uk", 4, 1, 59), ("w5xh0y", 1, 0, 0), ("w5xh0z", 3, 1, 40),
    ]
    counts = heatmap.resolution_counts(small["cases"], {5: "five", 6: "six", 7: "seven"})
    assert rows(counts.groupBy("level").count(), "level", "count") == [("five", 4), ("seven", 28), ("six", 10)]
    assert rows(counts.filter("level = 'five'"), "cell_id", "case_count") == [
        ("w4rw0", 12), ("w4rw2", 8), ("w5q6u", 6), ("w5xh0", 4),
    ]


def test_months(small, located):
    report = heatmap.cell_report(small["cases"])
    assert report.count() == 21
    first = report.filter("cell_id = 'w4rw04' AND report_month = '2024-07-01'").first()
    assert (first["case_count"], first["df_count"], first["dhf_count"], first["dss_count"], first["avg_age"]) == (4, 3, 0, 1, 25.8)
    assert rows(heatmap.latest_month(report), "cell_id", "case_count") == [
        ("w4rw23", 1), ("w5q6uk", 1), ("w5xh0y", 1), ("w5xh0z", 1),
    ]
    trend = rows(heatmap.monthly_trend(small["cases"]), "report_month", "case_count", "severe_cases", "avg_patient_age")
    assert trend == [
        (date(2024, 6, 1), 3, 1, 15.0), (date(2024, 7, 1), 12, 4, 25.2), (date(2024, 8, 1), 11, 5, 21.9), (date(2024, 9, 1), 4, 0, 24.0),
    ]
    change = heatmap.month_change(small["cases"]).orderBy(F.desc("month_change"), "cell_id", "report_month").limit(5)
    assert [(r["cell_id"], r["case_count"], r["prev_month_cases"]) for r in change.collect()] == [
        ("w4rw04", 2, 0), ("w4rw04", 4, 2), ("w4rw23", 2, 0), ("w5q6uk", 2, 0), ("w5xh0z", 2, 0),
    ]
    bangkok = heatmap.compare_resolutions(located.filter("region_name = 'Bangkok'"))
    assert rows(bangkok, "grid_precision", "cell_count", "total_cases", "avg_per_cell") == [
        (5, 2, 20, 10.0), (6, 6, 20, 3.3), (7, 19, 20, 1.1),
    ]
    assert rows(heatmap.severity_mix(small["cases"]), "severity", "case_count", "avg_age") == [
        ("DF", 20, 25.8), ("DHF", 7, 15.6), ("DSS", 3, 19.7),
    ]


def test_cells_in_red_zones(small, located):
    touched = heatmap.touched_cells(located, F.lit(500.0 / 111000.0), ["region_name"])
    joined = heatmap.overlap_join(heatmap.cell_report(small["cases"]), touched)
    assert joined.count() == 21
    prefix = {"Bangkok": "w4rw", "Chiang Mai": "w5q6", "Chiang Rai": "w5xh"}
    assert all(r["cell_id"].startswith(prefix[r["region_name"]]) for r in joined.collect())


def test_duplicate_keys(small):
    assert duplicate_keys(small["cases"], ["case_id"]).count() == 0
    assert rows(duplicate_keys(small["schools"], ["district"]), "district", "row_count") == [
        ("Din Daeng", 2), ("Khlong Toei", 2), ("Phra Nakhon", 2),
    ]


def test_nearest_does_not_depend_on_the_cells(spark, small):
    """Far-away cases, cases on a facility, ties, and any cell side."""
    places = [(100.4856, 13.7590), (0.0, 0.0), (-179.9, -89.0), (99.0, 16.0), (100.53425, 13.766), (None, 1.0)]
    cases = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(places)], "case_id int, lon double, lat double")
    hospitals = small["hospitals"].unionByName(
        spark.createDataFrame([(99, "Copy", "p", "d", 100.4856, 13.7590)], small["hospitals"].schema)
    )
    facts = [(r["id"], r["lon"], r["lat"]) for r in hospitals.collect()]
    wanted = [
        (i, min((((x - fx) ** 2 + (y - fy) ** 2) ** 0.5, f) for f, fx, fy in facts)[1])
        for i, (x, y) in enumerate(places) if x is not None
    ] + [(5, None)]
    for side in (0.005, 0.05, 3.0):
        assert rows(proximity.nearest_facility(cases, hospitals, cell_side=side), "case_id", "facility_id") == wanted


def test_pair_at_exactly_the_radius(spark):
    """Closed radius, whichever cells the two ends fall into."""
    step = 1000 / 111000.0
    facilities = spark.createDataFrame([(i, "f", i * step, 0.0) for i in range(50)], "id int, name string, lon double, lat double")
    cases = spark.createDataFrame([(i, i * step + step, 0.0) for i in range(50)], "case_id int, lon double, lat double")
    wanted = sorted(
        (f, c) for f in range(50) for c in range(50) if abs(f * step - (c * step + step)) <= step
    )
    assert rows(proximity.within_distance(facilities, cases, 1000), "id", "case_id") == wanted


def test_no_facility_in_range(spark, small):
    nowhere = spark.createDataFrame([(1, 0.0, 0.0, "DF")], "case_id int, lon double, lat double, severity string")
    assert scoring.case_load(small["schools"], nowhere, 1000).count() == 0
    assert proximity.within_distance(small["schools"], nowhere, 1000, how="left").filter("case_id IS NULL").count() == 10


def test_nearest_keeps_every_row(spark, small):
    """Repeated rows, one id at two places, no coordinates, and places off the globe."""
    places = [(1, 100.5, 13.7), (1, 100.5, 13.7), (1, 99.0, 18.8), (2, None, 13.0), (3, 5000.0, 13.0), (4, 100.0, float("nan")), (5, 100.0, -91.0)]
    cases = spark.createDataFrame(places, "case_id int, lon double, lat double")
    found = proximity.nearest_facility(cases, small["hospitals"], carry=("name",))
    assert found.columns == ["case_id", "lon", "lat", "facility_id", "name", "dist_deg"]
    assert [r[0] for r in rows(found.filter("facility_id IS NOT NULL"), "case_id")] == [1, 1, 1]
    assert found.filter("case_id = 1").select("facility_id").distinct().count() == 2
    assert [r[0] for r in rows(found.filter("name IS NULL"), "case_id")] == [2, 3, 4, 5]


@pytest.mark.parametrize("spread", [0.05, 3.0])
def test_nearest_meets_few_facilities(spark, spread):
    """Three thousand facilities and cases in one cell, and a dense city in a sparse country."""
    def places(seed, n, name):
        dense = spark.range(n).select(F.col("id").alias(name), (F.rand(seed) * 0.05 + 100).alias("lon"), (F.rand(seed + 1) * 0.05 + 13).alias("lat"))
        if spread == 0.05:
            return dense
        wide = spark.range(n, n + n // 10).select(F.col("id").alias(name), (F.rand(seed) * spread + 99).alias("lon"), (F.rand(seed + 1) * spread + 12).alias("lat"))
        return dense.unionAll(wide)

    cases, facilities = places(1, 3000, "case_id"), places(5, 3000, "id")
    pairs = proximity.nearest_pairs(cases, facilities, "id", "case_id", None, ())
    assert pairs.count() < 100 * cases.count()
    found = proximity.nearest_facility(cases, facilities)
    other = proximity.nearest_facility(cases, facilities, cell_side=0.01)
    assert rows(found, "case_id", "facility_id") == rows(other, "case_id", "facility_id")


@pytest.mark.parametrize("far", [2.0, 40.0])
def test_far_cases_meet_few_facilities(spark, far):
    """Four thousand cases far away from four thousand facilities: each meets the near rim only, and the answers are those of a plain
    comparison with all facilities."""
    def places(seed, n, name, x):
        return spark.range(n).select(F.col("id").alias(name), (F.rand(seed) * 2 + x).alias("lon"), (F.rand(seed + 1) * 2 + 13).alias("lat"))

    cases, facilities = places(11, 4000, "case_id", 100.0 + far + 2.0), places(15, 4000, "id", 100.0)
    pairs = proximity.nearest_pairs(cases, facilities, "id", "case_id", None, ())
    assert pairs.count() < 100 * cases.count()
    some = cases.filter("case_id % 40 = 0")
    facts = [tuple(r) for r in facilities.collect()]
    wanted = sorted(
        (c, min((((x - fx) ** 2 + (y - fy) ** 2) ** 0.5, f) for f, fx, fy in facts)[1]) for c, x, y in map(tuple, some.collect())
    )
    found = proximity.nearest_facility(cases, facilities).filter("case_id % 40 = 0")
    assert rows(found, "case_id", "facility_id") == wanted


def test_cells_with_very_many_candidates(spark, small, monkeypatch):
    """Candidates as pairs and as lists give the same rows."""
    cases = small["cases"].select("case_id", "lon", "lat")
    usual = rows(proximity.nearest_facility(cases, small["schools"], carry=("name",)), "case_id", "facility_id", "name", "dist_deg")
    monkeypatch.setattr(proximity, "LISTED", 1)
    assert rows(proximity.nearest_facility(cases, small["schools"], carry=("name",)), "case_id", "facility_id", "name", "dist_deg") == usual
    nobody = small["schools"].limit(0)
    alone = proximity.nearest_facility(cases, nobody, carry=("name",))
    assert alone.count() == cases.count() and alone.filter("facility_id IS NOT NULL").count() == 0

"""Declared schemas of the base tables."""

CASES = "case_id bigint, patient_age int, gender string, infection_date date, severity string, lon double, lat double"
SCHOOLS = "id bigint, name string, district string, lon double, lat double"
HOSPITALS = "id bigint, name string, province string, district string, lon double, lat double"
REGIONS = (
    "region_code string, region_name string, ring array<struct<x:double,y:double>>, "
    "x0 double, y0 double, x1 double, y1 double"
)
TIERS = "risk_tier string, radius_meters int"

# CSV exports that the map can be built from.
EXPORTS = {
    "hexbin_report": "wkt string, case_count bigint, severe_count bigint, avg_age double",
    "risk_zones": (
        "province_name string, risk_tier string, radius_meters int, case_count bigint, area_sq_km double, wkt string"
    ),
    "hospitals": "name string, province string, lon double, lat double",
    "schools": "name string, district string, lon double, lat double",
}

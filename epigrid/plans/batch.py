"""The batch that stores the derived tables."""

from pyspark.sql import DataFrame, functions as F

from epigrid.constants import SQKM_PER_SQDEG
from epigrid.functions.geo import round_half_up, to_degrees
from epigrid.functions.rings import parts_wkt
from epigrid.operators import heatmap, regions, zones
from epigrid.session import cut_lineage
from epigrid.sources.tables import replace_partitions, write_table


def build_tables(cases: DataFrame, boundaries: DataFrame) -> dict[str, DataFrame]:
    """Write the risk zones, the monthly cell report and their overlay as tables of the current namespace.

    The risk zones carry their merged geometry as text. Every write puts a whole new table in the place of the old one, so a second run
    gives the same tables and a failed one leaves the old ones. The cases are assigned to their regions once.
    """
    located = cut_lineage(regions.assign_region(cases, boundaries).drop("ring", "parts"), "located")
    places = zones.tiers_of(located.select("region_name", "lon", "lat").distinct())
    # one dissolve for geometry and areas
    outline = cut_lineage(zones.rings(places, ["region_name"]), "rings")
    shapes = zones.zone_parts(outline, ["region_name"])
    texts = shapes.select("region_name", "radius_meters", parts_wkt(F.col("parts")).alias("wkt"))
    areas = zones.ring_areas(outline, ["region_name"])
    measured = zones.risk_zones(located, merged=areas).join(texts, ["region_name", "radius_meters"], "left")
    risk = write_table(measured, "risk_zones")
    report = write_table(heatmap.cell_report(cases), "cell_report", partition_by="report_month")
    touched = heatmap.touched_cells(located, to_degrees(F.lit(500.0)), ["region_name"])
    red = risk.filter(F.col("risk_tier") == "RED").select("region_name", "risk_tier", "area_sq_km")
    overlay = red_zone_overlay(report, touched, red)
    return {"risk_zones": risk, "cell_report": report, "cells_in_red_zones": write_table(overlay, "cells_in_red_zones")}


def refresh_months(cases: DataFrame, first: str, last: str) -> DataFrame:
    """Report the months from the one that holds `first` to the one that holds `last` anew; all other months of the stored cell report
    keep their files. A case's month prunes what is read of the cases."""
    begin, end = (F.trunc(F.lit(day).cast("date"), "MM") for day in (first, last))
    wanted = (F.col("infection_date") >= begin) & (F.col("infection_date") < F.add_months(end, 1))
    return replace_partitions(heatmap.cell_report(cases.filter(wanted)), "cell_report", "report_month")


def red_zone_overlay(report: DataFrame, touched: DataFrame, red: DataFrame) -> DataFrame:
    """Report rows of the cells that a zone meets, with the zone's area and the cases per 100 sq km of it."""
    density = F.lit(100.0) * F.col("case_count") / F.nullif(F.col("area_sq_km"), F.lit(0.0))
    return (
        heatmap.overlap_join(report.select("report_month", "cell_id", "case_count"), touched)
        .join(red, "region_name")
        .select(
            "report_month",
            "cell_id",
            F.col("case_count").alias("cell_cases"),
            "risk_tier",
            "region_name",
            F.col("area_sq_km").alias("risk_zone_area"),
            round_half_up(density, 2).alias("cases_per_sq_km"),
        )
    )


def red_zones(located: DataFrame) -> DataFrame:
    """Merged area of the RED tier per region."""
    red = zones.tiers_of(located.select("region_name", "lon", "lat").distinct(), zones.RISK_TIERS[:1])
    area = round_half_up(F.col("area_deg2") * F.lit(SQKM_PER_SQDEG), 3)
    return zones.union_area(red, ["region_name"]).select(
        "region_name", F.lit("RED").alias("risk_tier"), area.alias("area_sq_km")
    )

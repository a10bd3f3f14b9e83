"""Reading points, polygons and CSV exports."""

import os
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from epigrid.constants import RISK_TIERS
from epigrid.functions.geo import to_degrees
from epigrid.functions.rings import box_ring, let, ring_wkt
from epigrid.sources import fixture, schemas

_NUMBER = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
_POINT = rf"(?i)^\s*POINT\s*\(\s*({_NUMBER})\s+({_NUMBER})\s*\)\s*$"
_RING = r"\(\s*[^()]*\)"
_PART = rf"\(\s*{_RING}(?:\s*,\s*{_RING})*\s*\)"
_POLYGON = rf"(?i)^\s*POLYGON\s*({_PART})\s*$"
_MULTIPOLYGON = rf"(?i)^\s*MULTIPOLYGON\s*\(\s*({_PART}(?:\s*,\s*{_PART})*)\s*\)\s*$"
_VERTEX = rf"^\s*{_NUMBER}\s+{_NUMBER}\s*$"


def point_from_wkt(wkt: Column) -> dict[str, Column]:
    """`lon` and `lat` of a point text, NULL where the text is not a point."""
    return {
        name: F.nullif(F.regexp_extract(wkt, _POINT, i), F.lit("")).cast("double") for i, name in ((1, "lon"), (2, "lat"))
    }


def parts_from_wkt(wkt: Column) -> Column:
    """Parts of a POLYGON or MULTIPOLYGON text, each an outer ring and its holes; NULL where it is neither, or a ring is not
    closed or not made of number pairs."""

    def vertex(text):
        return let(
            F.split(F.trim(text), r"\s+"),
            lambda p: F.struct(
                F.element_at(p, 1).cast("double").alias("x"), F.element_at(p, 2).cast("double").alias("y")
            ),
        )

    def ring(text):
        def parse(vertices):
            good = F.forall(vertices, lambda v: F.rlike(v, F.lit(_VERTEX))) & (F.size(vertices) >= 4)
            return let(
                F.when(good, F.transform(vertices, vertex)), lambda r: F.when(F.element_at(r, 1) == F.element_at(r, -1), r)
            )

        return let(F.split(F.regexp_replace(text, r"[()]", ""), ","), parse)

    def part(text):
        return F.transform(F.regexp_extract_all(text, F.lit(f"({_RING})"), F.lit(1)), ring)

    body = F.concat(F.regexp_extract(wkt, _POLYGON, 1), F.regexp_extract(wkt, _MULTIPOLYGON, 1))

    def whole(parts):
        good = (F.size(parts) > 0) & F.forall(parts, lambda rings: F.forall(rings, lambda r: r.isNotNull()))
        return F.when(good, parts)

    return let(F.transform(F.regexp_extract_all(body, F.lit(f"({_PART})"), F.lit(1)), part), whole)


def ring_from_wkt(wkt: Column) -> Column:
    """Outer ring of a polygon text with one ring; NULL for everything else."""

    def single(parts):
        return F.when((F.size(parts) == 1) & (F.size(F.element_at(parts, 1)) == 1), F.element_at(F.element_at(parts, 1), 1))

    return let(parts_from_wkt(wkt), single)


def ingest_wkt(df: DataFrame, wkt: str, kind: str = "point") -> tuple[DataFrame, DataFrame]:
    """Split rows into those whose `wkt` column parses (with coordinates instead of text) and the rejects.

    Polygons come with `parts`, all their rings, and with `ring`, the outer ring if there is no other.
    """
    if kind == "point":
        parsed = df.withColumns(point_from_wkt(F.col(wkt)))
        good = F.col("lon").isNotNull() & F.col("lat").isNotNull()
        added = ["lon", "lat"]
    elif kind == "polygon":
        parsed = with_box(df.withColumn("parts", parts_from_wkt(F.col(wkt))))
        alone = (F.size("parts") == 1) & (F.size(F.element_at("parts", 1)) == 1)
        parsed = parsed.withColumn("ring", F.when(alone, F.element_at(F.element_at("parts", 1), 1)))
        good = F.col("parts").isNotNull()
        added = ["ring", "parts", "x0", "y0", "x1", "y1"]
    else:
        raise ValueError(f"unknown kind {kind!r}")
    return parsed.filter(good).drop(wkt), parsed.filter(~good).drop(*added)


def with_box(df: DataFrame) -> DataFrame:
    """Add the bounding box of the `parts` column, or of `ring` where there is none."""
    corners = F.flatten(F.flatten("parts")) if "parts" in df.columns else F.col("ring")
    xs = F.transform(corners, lambda p: p["x"])
    ys = F.transform(corners, lambda p: p["y"])
    return df.withColumns(
        {"x0": F.array_min(xs), "y0": F.array_min(ys), "x1": F.array_max(xs), "y1": F.array_max(ys)}
    )


def load_csv(
    spark: SparkSession, path: str, schema: str, header: bool = True, bad_path: str | None = None
) -> DataFrame:
    """Read CSV rows into a declared schema.

    A row that does not fit stops the load, naming the row; with `bad_path` such rows are written there instead.
    """
    fields = T.StructType.fromDDL(schema)
    reader = spark.read.option("header", header)
    if bad_path is None:
        return reader.schema(fields).option("mode", "FAILFAST").csv(path)
    bad = "_corrupt_record"
    raw = (
        reader.schema(T.StructType([*fields.fields, T.StructField(bad, T.StringType())]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", bad)
        .csv(path)
    )
    # The reader does not accept a query on the corrupt column alone, so the whole row is kept.
    raw.filter(F.col(bad).isNotNull()).write.mode("overwrite").json(bad_path)
    return raw.filter(F.col(bad).isNull()).drop(bad)


def load_csv_exports(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The four exported map inputs. A missing file is an error, raised when the path is resolved; so is a field that does
    not fit, raised when the rows are read."""
    return {
        name: load_csv(spark, os.path.join(folder, f"{name}.csv"), schema) for name, schema in schemas.EXPORTS.items()
    }


def load_tables(spark: SparkSession, zones: str, report: str, hospitals: str, schools: str) -> dict[str, DataFrame]:
    """The four map inputs from stored tables, under the names that the exports have."""
    zone = spark.table(zones)
    if "region_name" in zone.columns:
        zone = zone.withColumnRenamed("region_name", "province_name")
    return {
        "hexbin_report": spark.table(report).selectExpr(
            "wkt", "case_count", "dhf_count + dss_count AS severe_count", "avg_age"
        ),
        "risk_zones": zone.select("province_name", "risk_tier", "radius_meters", "case_count", "area_sq_km", "wkt"),
        "hospitals": spark.table(hospitals).select("name", "province", "lon", "lat"),
        "schools": spark.table(schools).select("name", "district", "lon", "lat"),
    }


#: Conditions under which a source counts as missing. Anything else, such as an unknown column, is a fault of the source.
_MISSING = ("TABLE_OR_VIEW_NOT_FOUND", "PATH_NOT_FOUND", "SCHEMA_NOT_FOUND")


def first_available(*loaders: Callable[[], dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """Result of the first loader whose sources exist; the last one's error is raised, and every error but a missing source."""
    for loader in loaders[:-1]:
        try:
            return loader()
        except FileNotFoundError:
            continue
        except AnalysisException as error:
            if (error.getCondition() or "").split(".")[0] not in _MISSING:
                raise
    return loaders[-1]()


# Demo cells (x0, y0, side, cases, severe, average age) and provinces (name, cases, centre).
_DEMO_CELLS = (
    (100.550, 13.720, 0.006, 12, 3, 18.5),
    (100.556, 13.720, 0.006, 8, 2, 22.0),
    (100.554, 13.760, 0.006, 8, 3, 20.1),
    (98.978, 18.785, 0.006, 6, 1, 23.0),
    (99.876, 20.426, 0.006, 4, 1, 26.0),
)
_DEMO_PROVINCES = (
    ("Bangkok", 20, 100.5550, 13.7400),
    ("Chiang Mai", 6, 98.9820, 18.7870),
    ("Chiang Rai", 4, 99.8790, 20.4300),
)


def demo_layers(spark: SparkSession) -> dict[str, DataFrame]:
    """Built-in map inputs: five cells, nine square zones and the fixture's facilities."""
    tables = fixture.fixture_tables(spark)
    cells = spark.createDataFrame(
        list(_DEMO_CELLS), "x0 double, y0 double, side double, case_count bigint, severe_count bigint, avg_age double"
    ).withColumns({"x1": F.col("x0") + F.col("side"), "y1": F.col("y0") + F.col("side")})
    provinces = spark.createDataFrame(
        list(_DEMO_PROVINCES), "province_name string, case_count bigint, lon double, lat double"
    )
    tiers = F.array(
        *[F.struct(F.lit(t).alias("risk_tier"), F.lit(r).alias("radius_meters")) for t, r in RISK_TIERS]
    )
    zones = provinces.withColumn("tier", F.explode(tiers)).select("*", "tier.*")
    reach = to_degrees("radius_meters")
    km = F.col("radius_meters") / F.lit(1000.0)
    zones = zones.withColumns(
        {
            "area_sq_km": F.round(F.lit(3.14159) * km * km, 3),
            "x0": F.col("lon") - reach,
            "y0": F.col("lat") - reach,
            "x1": F.col("lon") + reach,
            "y1": F.col("lat") + reach,
        }
    )
    wkt = ring_wkt(box_ring(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))).alias("wkt")
    return {
        "hexbin_report": cells.select(wkt, "case_count", "severe_count", "avg_age"),
        "risk_zones": zones.select("province_name", "risk_tier", "radius_meters", "case_count", "area_sq_km", wkt),
        "hospitals": tables["hospitals"].select("name", "province", "lon", "lat"),
        "schools": tables["schools"].select("name", "district", "lon", "lat"),
    }

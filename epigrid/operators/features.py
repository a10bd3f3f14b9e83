"""Map features: points, polygons, styled zones and cells, and the extent of a layer."""

from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from epigrid.constants import RADIUS_STYLES, TIER_STYLES, UNKNOWN_STYLE
from epigrid.functions.colours import ramp_colour
from epigrid.functions.rings import number_text, ring_centroid
from epigrid.sources.ingest import parts_from_wkt, with_box


def point_features(df: DataFrame, lon: str = "lon", lat: str = "lat", popup_cols: list[str] | None = None) -> DataFrame:
    """Points with a popup of the named columns (by default all others) and the first of them as label."""
    shown = [c for c in popup_cols or [c for c in df.columns if c not in (lon, lat)] if c in df.columns]
    label = F.col(shown[0]).cast("string") if shown else F.lit("")
    return df.select(
        "*", label.alias("label"), fields_text(shown, "<b>{}:</b> ").alias("popup"),
    ).filter(F.col(lon).isNotNull() & F.col(lat).isNotNull())


def polygon_layer(df: DataFrame, wkt: str = "wkt", shown: int = 5) -> tuple[DataFrame, DataFrame]:
    """Polygons and multipolygons from text: their `parts` and a tooltip of the first columns; and the rows that make no feature,
    those without a text or with one that is no polygon, as they came."""
    names = [c for c in df.columns if c != wkt]
    parsed = df.withColumns({"parts": parts_from_wkt(F.col(wkt)), "tooltip": fields_text(names[:shown])})
    good = F.col("parts").isNotNull()
    return parsed.filter(good).drop(wkt), parsed.filter(~good).drop("parts", "tooltip")


def polygon_features(df: DataFrame, wkt: str = "wkt", shown: int = 5) -> DataFrame:
    """The features of `polygon_layer`; rows that make none are skipped."""
    return polygon_layer(df, wkt, shown)[0]


def zone_features(df: DataFrame, unknown: tuple[str, float] = UNKNOWN_STYLE, shown: int = 6) -> DataFrame:
    """Zones with colour and opacity, by tier, else by radius, else the unknown style, and a draw order.

    Larger zones come first in the order, so that smaller ones are drawn over them.
    """
    tier = F.upper(F.col("risk_tier")) if "risk_tier" in df.columns else F.lit(None).cast("string")
    radius = F.col("radius_meters").cast("int") if "radius_meters" in df.columns else F.lit(None).cast("int")

    def style(part: int) -> Column:
        by_tier, by_radius = (
            F.create_map(*chain.from_iterable((F.lit(key), F.lit(value[part])) for key, value in styles.items()))
            for styles in (TIER_STYLES, RADIUS_STYLES)
        )
        return F.coalesce(by_tier[tier], by_radius[radius], F.lit(unknown[part]))

    names = [c for c in df.columns if c not in ("wkt", "ring", "parts")]
    return df.withColumns(
        {
            "colour": style(0),
            "opacity": style(1),
            "draw_order": F.negative(F.coalesce(radius, F.lit(0))),
            "tooltip": fields_text(names[:shown]),
        }
    )


def cell_features(df: DataFrame, value: str = "case_count", shown: int = 5) -> DataFrame:
    """Cells with their intensity (value over the largest value, 0 if that is not positive) and its colour."""
    top = df.agg(F.max(value)).scalar()
    names = [c for c in df.columns if c not in ("wkt", "ring", "parts")]
    intensity = F.when(top > 0, F.col(value).cast("double") / top).otherwise(F.lit(0.0))
    return df.withColumn("intensity", intensity).withColumns(
        {"colour": ramp_colour(F.col("intensity")), "tooltip": fields_text(names[:shown])}
    )


def extent(df: DataFrame, lon: Column, lat: Column) -> DataFrame:
    """One row: the smallest box around the given positions of a layer."""
    return df.agg(
        F.min(lat).alias("min_lat"), F.min(lon).alias("min_lon"), F.max(lat).alias("max_lat"), F.max(lon).alias("max_lon")
    )


def ring_extent(df: DataFrame) -> DataFrame:
    """Extent of the centroids of the `ring` column."""
    centred = df.select(ring_centroid(F.col("ring")).alias("c"))
    return extent(centred, F.col("c.x"), F.col("c.y"))


def parts_extent(df: DataFrame) -> DataFrame:
    """Extent of all corners of the `parts` column; each row gives its own box first."""
    boxed = with_box(df.select("parts"))
    return boxed.agg(
        F.min("y0").alias("min_lat"), F.min("x0").alias("min_lon"), F.max("y1").alias("max_lat"), F.max("x1").alias("max_lon")
    )


def geojson(df: DataFrame, geometry: Column, properties: list[str]) -> DataFrame:
    """One GeoJSON feature per row, in the column `value`."""
    feature = F.struct(
        F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*properties).alias("properties")
    )
    return df.select(F.to_json(feature).alias("value"))


def point_geometry(lon: str = "lon", lat: str = "lat") -> Column:
    return F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))


def ring_geometry(ring: str = "ring") -> Column:
    corners = F.transform(ring, lambda p: F.array(p["x"], p["y"]))
    return F.struct(F.lit("Polygon").alias("type"), F.array(corners).alias("coordinates"))


def parts_geometry(parts: str = "parts") -> Column:
    """MultiPolygon geometry of all parts; a single part is a MultiPolygon of one."""
    corners = F.transform(
        parts, lambda rings: F.transform(rings, lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))
    )
    return F.struct(F.lit("MultiPolygon").alias("type"), corners.alias("coordinates"))


def geojson_text(df: DataFrame, kind: str, coordinates: Column, properties: list[str]) -> DataFrame:
    """The same with the coordinates as ready text, so that numbers look alike whichever engine wrote them."""
    parts = (F.lit(f'{{"type":"Feature","geometry":{{"type":"{kind}","coordinates":'), coordinates)
    return df.select(F.concat(*parts, F.lit('},"properties":'), F.to_json(F.struct(*properties)), F.lit("}")).alias("value"))


def position_text(x: Column, y: Column) -> Column:
    return F.concat(F.lit("["), number_text(x), F.lit(","), number_text(y), F.lit("]"))


def ring_text(ring: str = "ring") -> Column:
    """Coordinates of a polygon with one ring."""
    corners = F.transform(ring, lambda p: position_text(p["x"], p["y"]))
    return F.concat(F.lit("[["), F.array_join(corners, ","), F.lit("]]"))


def write_features(df: DataFrame, path: str) -> None:
    """Write GeoJSON features as JSON lines."""
    df.select("value").write.mode("overwrite").text(path)


def fields_text(names: list[str], pattern: str = "{}: ") -> Column:
    """`name: value` of the columns, joined by line breaks; NULL shows as `None`."""
    parts = [
        F.concat(F.lit(pattern.format(name)), F.coalesce(F.col(name).cast("string"), F.lit("None"))) for name in names
    ]
    return F.concat_ws("<br>", *parts) if parts else F.lit("")

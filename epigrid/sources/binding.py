"""Surveillance tables derived from the TPC-H-like parquet tables.

The parquet tables hold no coordinates, so longitude and latitude come from whole-number arithmetic on their keys and one
division; every engine gets the same doubles.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from epigrid.functions.rings import box_ring
from epigrid.sources.ingest import with_box


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, user = F.col("event_id"), F.col("user_id")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        event.alias("case_id"),
        ((event * 7 + user * 31) % 80).cast("int").alias("patient_age"),
        F.date_add(F.lit("2024-06-01").cast("date"), ((event * 7 + user * 13) % 122).cast("int")).alias(
            "infection_date"
        ),
        F.when(F.col("event_type") == "error", "DSS")
        .when(F.col("event_type") == "purchase", "DHF")
        .otherwise("DF")
        .alias("severity"),
        _lon(user, event).alias("lon"),
        _lat(user, event).alias("lat"),
    )


def schools(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        key.alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("district"),
        _lon(key, key).alias("lon"),
        _lat(key, key).alias("lat"),
    )


def hospitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        key.alias("id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("string").alias("province"),
        _lon(key, key).alias("lon"),
        _lat(key, key).alias("lat"),
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A closed box per nation; neighbouring boxes overlap by a tenth of a degree."""
    key = F.col("n_nationkey")
    boxes = spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        key.cast("string").alias("region_code"),
        F.col("n_name").alias("region_name"),
        (F.lit(98) + key % 5).cast("double").alias("x0"),
        (F.lit(13) + F.floor(key / 5)).cast("double").alias("y0"),
    )
    boxes = boxes.withColumn("x1", F.col("x0") + F.lit(1.1)).withColumn("y1", F.col("y0") + F.lit(1.1))
    ring = box_ring(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
    return boxes.select("region_code", "region_name", ring.alias("ring"), "x0", "y0", "x1", "y1")


#: Shapes of an area, as corners relative to its lower left corner: parts, each an outer ring and its holes.
AREA_SHAPES = (
    # a box with a hole, and an island in the hole
    (
        (((0.0, 0.0), (1.1, 0.0), (1.1, 1.1), (0.0, 1.1)), ((0.3, 0.3), (0.6, 0.3), (0.6, 0.7), (0.3, 0.7))),
        (((0.4, 0.4), (0.5, 0.4), (0.5, 0.5), (0.4, 0.5)),),
    ),
    # a slanted quadrilateral and a triangle apart from it
    (
        (((0.0, 0.0), (0.9, 0.2), (0.7, 1.0), (0.1, 0.8)),),
        (((0.9, 0.5), (1.3, 0.6), (1.0, 1.1)),),
    ),
    # the first one's box with another hole
    ((((0.0, 0.0), (1.1, 0.0), (1.1, 1.1), (0.0, 1.1)), ((0.2, 0.2), (0.9, 0.5), (0.5, 0.9))),),
)
#: Which shape an area's key has; keys that have a second shape under the same attributes; keys whose row is there twice.
AREA_SHAPE, AREA_SECOND, AREA_TWICE = "{key} % 2", "{key} % 14 = 0", "{key} % 6 = 1"


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions of several parts with holes: some rows stand twice, and some have the attributes and the box of another row but a
    shape of their own."""
    key = F.col("n_nationkey")
    base = spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        key, F.concat(F.lit("AREA_"), (key % 20).cast("string")).alias("region_name"),
        (F.lit(98) + key % 5).cast("double").alias("_x"), (F.lit(13) + F.floor(key / 5)).cast("double").alias("_y"),
    )

    def ring(corners):
        closed = (*corners, corners[0])
        return F.array(*[F.struct((F.col("_x") + x).alias("x"), (F.col("_y") + y).alias("y")) for x, y in closed])

    shapes = [F.array(*[F.array(*[ring(r) for r in part]) for part in shape]) for shape in AREA_SHAPES]
    n = "n_nationkey"
    chosen = F.when(F.expr(AREA_SHAPE.format(key=n)) == 0, shapes[0]).otherwise(shapes[1])
    rows = base.withColumn("parts", chosen)
    second = base.filter(AREA_SECOND.format(key=n)).withColumn("parts", shapes[2])
    twice = rows.filter(AREA_TWICE.format(key=n))
    return with_box(rows.unionAll(second).unionAll(twice).drop("n_nationkey", "_x", "_y"))


def _lon(cluster: Column, jitter: Column) -> Column:
    return (F.lit(98020000) + (cluster * 331777) % 4960000 + (jitter * 7919) % 40001 - 20000) / F.lit(1e6)


def _lat(cluster: Column, jitter: Column) -> Column:
    return (F.lit(13020000) + (cluster * 517413) % 4960000 + (jitter * 6101) % 40001 - 20000) / F.lit(1e6)

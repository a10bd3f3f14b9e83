"""Assignment of points to regions."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from epigrid.functions.rings import parts_edges, ring_edges
from epigrid.operators.joins import cell_join
from epigrid.session import cut_lineage

# Side of a region cell in degrees.
REGION_SIDE = 0.05
# Where in a cell its reference point lies, in sides: off any lattice that borders and points are likely to lie on, so that no edge
# passes through it and rounding can't decide.
REFERENCE = (0.3819660112501051, 0.4142135623730950)
# A cover is broadcast if its measured size is at most this.
BROADCAST_BYTES = 64 << 20
_BOX = ("x0", "y0", "x1", "y1")
_SHAPE = ("ring", "parts")


def region_cells(regions: DataFrame, side: float = REGION_SIDE) -> DataFrame:
    """Grid cover of the regions: one row per region and cell that it meets.

    `whole` marks cells that lie inside the region, where no point needs a test. A border cell carries the edges that touch it
    and whether its reference point `_cx`, `_cy` is inside; `inside_cell` decides by them alone. The work follows the edges:
    each is dealt to the cells that it passes, and the reference points' insides come from running counts of the crossings along each
    row of cells. So it grows with the border's length and spreads over tasks, whatever the shape or the number of rings.

    Every row of `regions` counts for itself, also one that repeats another, or that has another's attributes and a shape of its own:
    rows are numbered, equal shapes share the cover of the first one, and the cover is dealt back to all rows of the shape.
    """
    s, key = F.lit(side), ["_region", "_gy"]
    # stored, so that the numbers are fixed
    rows = cut_lineage(regions.withColumn("_row", F.monotonically_increasing_id()), "region-rows")
    geometry = [c for c in _SHAPE if c in regions.columns]
    same_shape = F.min("_row").over(Window.partitionBy(*geometry))
    numbered = rows.withColumn("_region", same_shape)
    shape = parts_edges(F.col("parts")) if "parts" in regions.columns else ring_edges(F.col("ring"))
    edges = numbered.filter("_region = _row").select("_region", F.explode(shape).alias("_e"))
    ax, ay, bx, by = (F.col(f"_e.{end}.{axis}") for end in "ab" for axis in "xy")
    # A margin far above rounding: an edge on a cell's side belongs to both cells.
    pad = F.lit(side * 1e-6)

    def cell(value: Column) -> Column:
        return F.floor(value / s)

    def x_at(y: Column) -> Column:
        return F.when(ay == by, ax).otherwise(ax + (y - ay) * (bx - ax) / F.nullif(by - ay, F.lit(0.0)))

    rowed = edges.withColumn("_gy", F.explode(F.sequence(cell(F.least(ay, by) - pad), cell(F.greatest(ay, by) + pad))))
    low, high = F.col("_gy") * s - pad, (F.col("_gy") + 1) * s + pad
    # the stretch of the edge within the row of cells
    from_y, to_y = F.greatest(F.least(ay, by), low), F.least(F.greatest(ay, by), high)
    ends = (F.when(ay == by, F.least(ax, bx)).otherwise(F.least(x_at(from_y), x_at(to_y))),
            F.when(ay == by, F.greatest(ax, bx)).otherwise(F.greatest(x_at(from_y), x_at(to_y))))
    passed = F.sequence(cell(F.greatest(ends[0], F.least(ax, bx)) - pad), cell(F.least(ends[1], F.greatest(ax, bx)) + pad))
    border = (
        rowed.withColumn("_gx", F.explode(passed))
        .groupBy(*key, "_gx")
        .agg(F.collect_list("_e").alias("_edges"))
        .withColumns({"_cx": (F.col("_gx") + REFERENCE[0]) * s, "_cy": (F.col("_gy") + REFERENCE[1]) * s})
    )
    # where edges cross the height of the reference points of a row of cells
    line = (F.col("_gy") + REFERENCE[1]) * s
    crossings = rowed.filter((ay > line) != (by > line)).select(*key, x_at(line).alias("_x"))
    # asked for are the reference points of the border cells, and of the cells to their left
    asked = [
        border.select(*key, place.alias("_x"), F.lit(0).alias("_odd"), "_gx", F.lit(left).alias("_left"))
        for place, left in ((F.col("_cx"), False), ((F.col("_gx") - 1 + REFERENCE[0]) * s, True))
    ]
    events = asked[0].unionByName(asked[1]).unionByName(crossings.withColumn("_odd", F.lit(1)), allowMissingColumns=True)
    along = Window.partitionBy(*key).orderBy("_x", F.desc("_odd")).rowsBetween(Window.unboundedPreceding, 0)
    placed = events.withColumn("_inside", F.sum("_odd").over(along) % 2 == 1).filter(F.col("_gx").isNotNull()).drop("_x", "_odd")
    cornered = border.join(placed.filter(~F.col("_left")).drop("_left"), [*key, "_gx"])
    # the cells between two border cells of a row are whole if the one left of the right border cell is inside
    before = F.lag("_gx").over(Window.partitionBy(*key).orderBy("_gx"))
    gaps = placed.filter("_left").withColumn("_before", before).filter(F.col("_inside") & (F.col("_gx") - F.col("_before") > 1))
    between = gaps.select(*key, F.explode(F.sequence(F.col("_before") + 1, F.col("_gx") - 1)).alias("_gx"))
    cells = cornered.withColumn("whole", F.lit(False)).unionByName(
        between.withColumn("whole", F.lit(True)), allowMissingColumns=True
    )
    return cells.join(numbered.drop(*geometry, "_row"), "_region").drop("_region")


def inside_cell(x: Column, y: Column) -> Column:
    """Closed test of a point in a border cell: from the cell's reference point up or down to the point's height, then left or right to
    the point, and the inside changes at every edge crossed."""

    def on_edge(e):
        a, b = e["a"], e["b"]
        cross = (b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"])
        within = x.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"]))
        return (cross == 0.0) & within & y.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))

    cx, cy = F.col("_cx"), F.col("_cy")

    def crossed(e):
        a, b = e["a"], e["b"]
        y_at = a["y"] + (cx - a["x"]) * (b["y"] - a["y"]) / F.nullif(b["x"] - a["x"], F.lit(0.0))
        x_at = a["x"] + (y - a["y"]) * (b["x"] - a["x"]) / F.nullif(b["y"] - a["y"], F.lit(0.0))
        upwards = ((a["x"] > cx) != (b["x"] > cx)) & (y_at > F.least(cy, y)) & (y_at <= F.greatest(cy, y))
        sideways = ((a["y"] > y) != (b["y"] > y)) & (x_at > F.least(cx, x)) & (x_at <= F.greatest(cx, x))
        return F.coalesce(upwards, F.lit(False)).cast("int") + F.coalesce(sideways, F.lit(False)).cast("int")

    changes = F.aggregate("_edges", F.lit(0), lambda n, e: n + crossed(e))
    return F.exists("_edges", on_edge) | (F.col("_inside") != (changes % 2 == 1))


def assign_region(points: DataFrame, regions: DataFrame, point_id: str = "case_id") -> DataFrame:
    """Join every point with all regions that contain it (closed: a border belongs to both sides).

    A point in two overlapping regions gives two rows, also if they are the same region listed twice; a point in none gives no
    row. Adds the region's columns apart from its geometry.
    """
    s = F.lit(REGION_SIDE)
    cells = cut_lineage(region_cells(regions), "region-cells")
    located = points.withColumns({"_gx": F.floor(F.col("lon") / s), "_gy": F.floor(F.col("lat") / s)})
    size = cells.agg(F.sum(F.lit(100) + 40 * F.coalesce(F.size("_edges"), F.lit(0)))).first()[0] or 0
    joined = cell_join(located, cells, ["_gx", "_gy"], point_id, size <= BROADCAST_BYTES)
    in_box = F.col("lon").between(F.col("x0"), F.col("x1")) & F.col("lat").between(F.col("y0"), F.col("y1"))
    inside = F.col("whole") | (in_box & inside_cell(F.col("lon"), F.col("lat")))
    return joined.filter(inside).drop("_gx", "_gy", "_edges", "_inside", "_cx", "_cy", "whole", *_BOX)

"""Distance joins and nearest-facility search."""

import math

from pyspark.sql import DataFrame, Window, functions as F

from epigrid import constants
from epigrid.functions.geo import dist_deg
from epigrid.operators.joins import at_most, cell_join, neighbours, offset_array, salted_join
from epigrid.session import cut_lineage

# Side of a search cell in `nearest_facility`, in degrees, and the widest cell, wide enough to span the globe.
SEARCH_SIDE = 0.05
WIDEST_CELL = 720.0
# Levels that the search goes down at once, and candidates of a cell that travel as one list.
DOWN = 3
LISTED = 1_000
_CASE_CELL = ("_gx", "_gy", "x0", "y0", "x1", "y1")


def within_distance(
    facilities: DataFrame,
    cases: DataFrame,
    metres: float,
    how: str = "inner",
    facility_id: str = "id",
    case_id: str = "case_id",
) -> DataFrame:
    """Facility-case pairs at most `metres` apart (closed), with their distance `dist_deg`.

    Both sides get a grid cell as wide as the radius; the facilities are copied to the 3 x 3 cells around them, so the
    range join becomes an equi-join on the cell in which each pair meets once. Case coordinates come back as `case_lon`
    and `case_lat`. With `how="left"` facilities without a case are kept.
    """
    radius = metres / constants.M_PER_DEG
    # Slightly wider than the radius: rounding must not put a pair at exactly the radius two cells apart.
    side = F.lit(radius * (1 + 1e-9))
    around = (
        facilities.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull())
        .withColumn("_o", F.explode(offset_array(neighbours())))
        .withColumns({"_gx": F.floor(F.col("lon") / side) + F.col("_o.dx"), "_gy": F.floor(F.col("lat") / side) + F.col("_o.dy")})
        .drop("_o")
    )
    located = cases.withColumnsRenamed({"lon": "case_lon", "lat": "case_lat"}).withColumns(
        {"_gx": F.floor(F.col("case_lon") / side), "_gy": F.floor(F.col("case_lat") / side)}
    )
    # what would be broadcast are the copies
    small = at_most(facilities, constants.BROADCAST_ROWS // len(neighbours()))
    tasks = None if small else math.ceil(cases.count() / constants.PAIR_ROWS)
    pairs = (
        cell_join(located, around, ["_gx", "_gy"], case_id, small, tasks=tasks)
        .withColumn("dist_deg", dist_deg("lon", "lat", "case_lon", "case_lat"))
        .filter(F.col("dist_deg") <= F.lit(radius))
        .drop("_gx", "_gy")
    )
    if how == "inner":
        return pairs
    if how == "left":
        # Not an outer join on the facility: a facility with very many cases would be one task.
        alone = facilities.join(pairs.select(facility_id).distinct(), facility_id, "left_anti")
        return pairs.unionByName(alone, allowMissingColumns=True)
    raise ValueError(f"unknown join type {how!r}")


def nearest_to_point(facilities: DataFrame, lon: float, lat: float, k: int, facility_id: str = "id") -> DataFrame:
    """The k facilities nearest to a constant point, nearest first."""
    ranked = facilities.withColumn("dist_deg", dist_deg("lon", "lat", lon, lat))
    return ranked.filter(F.col("dist_deg").isNotNull()).orderBy("dist_deg", facility_id).limit(k)


def nearest_facility(
    cases: DataFrame,
    facilities: DataFrame,
    facility_id: str = "id",
    case_id: str = "case_id",
    cell_side: float | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """The nearest facility of every case, as `facility_id` and `dist_deg`; ties go to the lower id.

    Every case keeps its row, also one that repeats another: without coordinates, or outside +-180 and +-90 degrees, it has no
    facility. The columns of the facility named in `carry` come along.

    `cell_side` changes the work, not the answer; without it, `search_side` picks one for the densest places.

    No case is compared with all facilities, near or far. The search runs on occupied grid cells, whose number does not grow with
    the cases in them: `candidate_facilities` finds, per cell, the facilities that can be nearest to some point in its box. A cell's
    candidates travel as one list, so that a case is looked up once and never shuffled again; cells with very many take the form of
    pairs instead.
    """
    columns = cases.columns
    on_globe = F.coalesce(F.col("lon").between(-180, 180) & F.col("lat").between(-90, 90), F.lit(False))
    placed, load, found = _search(cases.filter(on_globe), facilities.filter(on_globe), facility_id, cell_side, carry)
    counts = found.groupBy("_many").agg(F.count(F.lit(1)).alias("n")).collect()  # two rows
    rows = {r["_many"]: r["n"] for r in counts}

    spot = F.struct("_fid", "f_lon", "f_lat", "_carried")
    lists = found.filter("NOT _many").groupBy("_gx", "_gy").agg(F.collect_list(spot).alias("_spots"))
    small = rows.get(False, 0) <= constants.BROADCAST_ROWS
    listed = cell_join(placed, lists, ["_gx", "_gy"], case_id, small, load)
    by_place = F.transform(
        "_spots", lambda f, i: F.struct(dist_deg("lon", "lat", f["f_lon"], f["f_lat"]).alias("d"), f["_fid"].alias("f"), i.alias("i"))
    )
    chosen = listed.withColumn("_best", F.array_min(by_place)).select(
        *columns, F.get("_spots", F.col("_best.i"))["_carried"].alias("_carried"), F.col("_best.d").alias("dist_deg")
    )
    if rows.get(True):
        pairs = salted_join(placed, found.filter("_many").drop("_many"), ["_gx", "_gy"], case_id, load=load)
        away = dist_deg("lon", "lat", "f_lon", "f_lat")
        first = F.min_by(F.struct(*columns, "_carried", away.alias("dist_deg")), F.struct(away, "_fid")).alias("_best")
        chosen = chosen.unionByName(pairs.groupBy("_row").agg(first).select("_best.*"))
    result = chosen.select(*columns, "_carried.*", "dist_deg")
    alone = cases.filter(~on_globe)
    if not rows:  # no facility at all
        alone = cases
    return result.unionByName(alone, allowMissingColumns=True)


def search_side(facilities: DataFrame, wanted: int = 4, finest: int = 12) -> float:
    """The widest search cell in which an average facility has at most `wanted` in its own cell, itself included.

    One pass over the facilities; the driver sees one row per level.
    """
    widths = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(SEARCH_SIDE / 2**k).alias("w")) for k in range(finest + 1)])
    spread = facilities.select("lon", "lat", F.explode(widths).alias("_l"))
    cells = spread.groupBy("_l.k", F.floor(F.col("lon") / F.col("_l.w")), F.floor(F.col("lat") / F.col("_l.w"))).count()
    crowd = cells.groupBy("k").agg((F.sum(F.col("count") * F.col("count")) / F.sum("count")).alias("n"))
    found = [r["k"] for r in crowd.filter(F.col("n") <= wanted).collect()]
    return SEARCH_SIDE / 2 ** min(found, default=finest)


def _search(
    cases: DataFrame, facilities: DataFrame, facility_id: str, cell_side: float | None, carry: tuple[str, ...]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The cases, all with coordinates, with their cell and a row number; the occupied cells with their number of cases `_n`; and the
    candidates of each cell."""
    places = _places(facilities, facility_id, carry)
    cell_side = cell_side or search_side(places)
    cell = {g: F.floor(F.col(c) / F.lit(cell_side)) for g, c in (("_gx", "lon"), ("_gy", "lat"))}
    # The number of a row depends on the partition it is read in, so a recomputed task gives the same one.
    placed = cases.withColumns({**cell, "_row": F.monotonically_increasing_id()})
    box = [f(c).alias(n) for f, c, n in ((F.min, "lon", "x0"), (F.min, "lat", "y0"), (F.max, "lon", "x1"), (F.max, "lat", "y1"))]
    load = cut_lineage(placed.groupBy("_gx", "_gy").agg(*box, F.count(F.lit(1)).alias("_n")), "case-cells")
    return placed, load, candidate_facilities(load, places, cell_side)


def nearest_pairs(
    cases: DataFrame, facilities: DataFrame, facility_id: str, case_id: str, cell_side: float | None, carry: tuple[str, ...]
) -> DataFrame:
    """The cases, all with coordinates, with the facilities that can be nearest to some point of their cell's box."""
    placed, load, found = _search(cases, facilities, facility_id, cell_side, carry)
    return salted_join(placed, found.drop("_many"), ["_gx", "_gy"], case_id, load=load)


def _places(facilities: DataFrame, facility_id: str, carry: tuple[str, ...]) -> DataFrame:
    """One facility per place, the first by id, with what is carried along: only that one can win."""
    carried = F.struct(F.col(facility_id).alias("facility_id"), *carry)
    return facilities.groupBy("lon", "lat").agg(
        F.min(facility_id).alias("_fid"), F.min_by(carried, facility_id).alias("_carried")
    )


def candidate_facilities(case_cells: DataFrame, places: DataFrame, cell_side: float) -> DataFrame:
    """(_gx, _gy, _fid, f_lon, f_lat, _carried, _many): per case cell the places that can be nearest to a point of its box.

    `case_cells` holds the box x0 .. y1 of the cases of each occupied cell. Branch and bound over a pyramid of facility cells, each
    level twice as wide as the one below: the first level at which the 3 x 3 cells around hold a facility bounds how far the nearest one
    is, so two levels up the 3 x 3 cells hold every candidate. Of those the search opens the cells of the first level whose smallest
    distance is not above the smallest of all largest distances, and goes down from there three levels at a time, opening only what the
    bound leaves. A far case meets the cells along the near rim of the facilities, not all of them. The number of steps follows the
    logarithm of the distance. `_many` marks cells with over LISTED candidates.
    """
    side = F.lit(cell_side)
    top = math.ceil(math.log2(WIDEST_CELL / cell_side))
    spots = places.select(
        F.col("lon").alias("f_lon"), F.col("lat").alias("f_lat"), F.floor(F.col("lon") / side).alias("_hx"),
        F.floor(F.col("lat") / side).alias("_hy"), "_fid", "_carried",
    )
    finest = spots.groupBy("_hx", "_hy").agg(
        F.min("f_lon").alias("hx0"), F.min("f_lat").alias("hy0"), F.max("f_lon").alias("hx1"), F.max("f_lat").alias("hy1")
    )
    levels = F.explode(F.sequence(F.lit(0), F.lit(top)))
    box = [f(c).alias(c) for f, c in ((F.min, "hx0"), (F.min, "hy0"), (F.max, "hx1"), (F.max, "hy1"))]
    pyramid = finest.withColumn("_level", levels).groupBy(
        "_level", _coarser("_hx", "_level").alias("_lx"), _coarser("_hy", "_level").alias("_ly")
    )
    pyramid = cut_lineage(pyramid.agg(*box), "facility-pyramid")

    # How far out: the first level at which the 3 x 3 cells around hold a facility.
    around = F.explode(offset_array(neighbours()))
    near = (
        pyramid.withColumn("_o", around)
        .select("_level", (F.col("_lx") + F.col("_o.dx")).alias("_lx"), (F.col("_ly") + F.col("_o.dy")).alias("_ly"))
        .distinct()
    )
    first = (
        case_cells.select("_gx", "_gy", "x0", "y0", "x1", "y1", levels.alias("_level"))
        .withColumns({"_lx": _coarser("_gx", "_level"), "_ly": _coarser("_gy", "_level")})
        .join(near, ["_level", "_lx", "_ly"])
        .groupBy("_gx", "_gy", "x0", "y0", "x1", "y1")
        .agg(F.min("_level").alias("_level"))
    )

    # Its cells within the 3 x 3 cells two levels up.
    up = F.least(F.lit(2), F.lit(top) - F.col("_level"))
    search = (
        first.withColumn("_up", up)
        .withColumn("_o", around)
        .withColumns(
            {
                "_px": F.call_function("shiftright", F.col("_gx"), F.col("_level") + F.col("_up")) + F.col("_o.dx"),
                "_py": F.call_function("shiftright", F.col("_gy"), F.col("_level") + F.col("_up")) + F.col("_o.dy"),
            }
        )
        .drop("_o", "_up")
    )
    opened = pyramid.withColumns({"_px": F.call_function("shiftright", F.col("_lx"), up), "_py": F.call_function("shiftright", F.col("_ly"), up)})
    state = _bounded(search.join(opened, ["_level", "_px", "_py"]).drop("_px", "_py"), "hx0", "hy0", "hx1", "hy1")
    state = cut_lineage(state, "facility-cells")
    while (deepest := state.agg(F.max("_level")).first()[0] or 0) > 0:
        down = F.least(F.lit(DOWN), F.col("_level"))
        waiting = state.filter("_level > 0").select(*_CASE_CELL, (F.col("_level") - down).alias("_level"), down.alias("_down"), "_lx", "_ly")
        steps = F.array_distinct(F.array(F.lit(DOWN), F.when(F.col("_level") == 0, 1).otherwise(DOWN), F.when(F.col("_level") == 0, 2).otherwise(DOWN)))
        children = (
            pyramid.filter(F.col("_level") <= max(0, deepest - 1))
            .withColumn("_down", F.explode(steps))
            .withColumns({"_px": F.call_function("shiftright", F.col("_lx"), F.col("_down")), "_py": F.call_function("shiftright", F.col("_ly"), F.col("_down"))})
        )
        parents = waiting.withColumnsRenamed({"_lx": "_px", "_ly": "_py"})
        inner = parents.join(children, ["_level", "_down", "_px", "_py"]).drop("_down", "_px", "_py")
        rest = state.filter("_level = 0")
        state = cut_lineage(_bounded(inner.unionByName(rest), "hx0", "hy0", "hx1", "hy1"), "facility-cells")
    cells = state.select(*_CASE_CELL, F.col("_lx").alias("_hx"), F.col("_ly").alias("_hy"))
    candidates = _bounded(cells.join(spots, ["_hx", "_hy"]), "f_lon", "f_lat", "f_lon", "f_lat")
    many = F.count(F.lit(1)).over(Window.partitionBy("_gx", "_gy")) > LISTED
    return cut_lineage(candidates.select("_gx", "_gy", "_fid", "f_lon", "f_lat", "_carried", many.alias("_many")), "facility-candidates")


def _bounded(pairs: DataFrame, *corners: str) -> DataFrame:
    """Pairs of a case cell and a box that can hold the nearest facility of some point of the cell."""
    bound = F.min(_box_gap("max", *corners)).over(Window.partitionBy("_gx", "_gy"))
    return pairs.withColumn("_far", bound).filter(_box_gap("min", *corners) <= F.col("_far")).drop("_far")


def _coarser(index: str, level: str):
    """Index of the cell 2^level times as wide. A shift rounds down for negative numbers too."""
    return F.call_function("shiftright", F.col(index), F.col(level))


def _box_gap(which: str, hx0: str, hy0: str, hx1: str, hy1: str):
    """Smallest or largest distance between the points of box (x0..y1) and of box (hx0..hy1)."""
    if which == "min":
        dx = F.greatest(F.col(hx0) - F.col("x1"), F.col("x0") - F.col(hx1), F.lit(0.0))
        dy = F.greatest(F.col(hy0) - F.col("y1"), F.col("y0") - F.col(hy1), F.lit(0.0))
    else:
        dx = F.greatest(F.col(hx1) - F.col("x0"), F.col("x1") - F.col(hx0))
        dy = F.greatest(F.col(hy1) - F.col("y0"), F.col("y1") - F.col(hy0))
    return F.sqrt(dx * dx + dy * dy)

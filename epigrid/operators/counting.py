"""Counts and nearest distances around facilities without making their pairs.

Cases are counted once per tile of a grid. A tile that lies wholly between two of the asked radii is added as one number; a place goes
only to the tiles on a rim, and to those that can hold its nearest case, and is counted there in the task that has the tile's cases. What is
shuffled are cases and places, a bounded number of tiles each, and never their pairs.
"""

import math

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from epigrid import constants
from epigrid.functions.geo import dist_deg
from epigrid.operators.joins import at_most, cell_join, neighbours, offset_array
from epigrid.operators.proximity import within_distance
from epigrid.operators.tile_counts import tile_counter
from epigrid.session import cut_lineage

# Cases that a finest cell should hold, the finest level, and the first one that costs less than the pairs.
WANTED = 8
FINEST = 10
WORTH = 2
# How often a tile halves a cell as wide as the last radius at most, and how many more halvings would leave WANTED cases in it.
TILES, FULL = 4, 1
# Tiles that are few, and cases that make up for more of them.
FEW_TILES, FULL_TILE = 4_000, 2_000
# Places and cases of a tile that a task takes at once; work of a tile by itself, and of a task, in places times rows of a tile;
# places that a task holds against the tiles around them.
PLACES, CASES = 100_000, 500_000
MET_PLACES = 2_000
TILE_WORK, TASK_WORK = 10_000, 4_000_000


def ring_counts(
    facilities: DataFrame,
    cases: DataFrame,
    radii: list[float],
    by: tuple[str, ...] = (),
    nearest: bool = True,
    case_id: str = "case_id",
    depth: int | None = None,
) -> DataFrame:
    """The facilities with the cases around them: `_ring`, the columns named in `by`, `_n` and `_near`.

    `_ring` is the number, from 0, of the first of the rising `radii` (metres, closed) that holds the cases, and `_n` says how many. A
    facility has any number of rows per ring and value of `by`: add `_n` up, and take the least `_near`, which is the distance in degrees
    of its nearest case; without `nearest` it means nothing. A row with `_ring` null and `_n` 0 only carries a distance. Facilities without
    a case do not appear; repeated facilities count each for themselves; rows without coordinates take no part. `by` is for columns of
    few values, which a cell carries along as a list.

    `depth` changes the work, not the answer: the number of times that a cell as wide as the last radius is halved. Without it
    `count_depth` picks one for the densest places, and thin cases are joined as pairs.
    """
    if list(radii) != sorted(set(radii)) or not radii:
        raise ValueError("radii must rise")
    degrees = [float(r) / constants.M_PER_DEG for r in radii]
    # Slightly wider than the radius, as in `within_distance`.
    side = degrees[-1] * (1 + 1e-9)
    depth = count_depth(cases, side) if depth is None else depth
    if depth < 1:
        pairs = within_distance(facilities, cases.select(case_id, "lon", "lat", *by), radii[-1], case_id=case_id)
        return pairs.select(
            *facilities.columns, _ring(F.col("dist_deg"), degrees).alias("_ring"), *by, F.lit(1).cast("bigint").alias("_n"),
            F.col("dist_deg").alias("_near"),
        )
    around = _around_places(facilities, cases, degrees, side, by, nearest, case_id, depth)
    return facilities.join(around, ["lon", "lat"]).select(*facilities.columns, "_ring", *by, "_n", "_near")


def count_depth(cases: DataFrame, side: float) -> int:
    """How often a cell of this side is to be halved so that a case of the densest places shares its cell with about WANTED.

    One pass over the cases; the driver sees one row.
    """
    depth = min(FINEST, math.floor(math.log(_crowd(cases, side)[0] / WANTED, 4)))
    return depth if depth >= WORTH else 0


def _crowd(cases: DataFrame, side: float) -> tuple[float, int]:
    """How many cases a case finds in its cell of this side on average, itself included, and how many cells are occupied."""
    cells = cases.filter(_placed()).groupBy(F.floor(F.col("lon") / F.lit(side)), F.floor(F.col("lat") / F.lit(side))).count()
    n = F.col("count").cast("double")
    crowd, occupied = cells.agg(F.sum(n * n) / F.sum(n), F.count(F.lit(1))).first()
    return crowd or 1.0, occupied


def _halvings(cases: DataFrame, side: float, depth: int) -> int:
    """How often to halve a cell of this side for the tiles, below zero to double it: a tile costs a task some milliseconds by itself, so
    there are few of them unless each has many cases."""
    crowd, occupied = _crowd(cases, side)
    halved = min(TILES, depth - FULL)
    while occupied * 4.0**halved > FEW_TILES and crowd / 4.0**halved < FULL_TILE:
        halved -= 1
    return halved


def _placed() -> Column:
    """Rows with coordinates. A box with a NaN corner would bound nothing."""
    return F.col("lon").isNotNull() & F.col("lat").isNotNull() & ~F.isnan("lon") & ~F.isnan("lat")


def _around_places(
    facilities: DataFrame, cases: DataFrame, degrees: list[float], side: float, by: tuple[str, ...], nearest: bool, case_id: str, depth: int
) -> DataFrame:
    """(lon, lat, _ring, *by, _n, _near), aggregated, for every place of a facility with a case in reach.

    Sums, products and roots of doubles do not fall when their arguments rise, so the gaps between a place and the corners of a tile's box bound
    the computed distances of its cases without any tolerance.
    """
    reach = degrees[-1]
    halved = _halvings(cases, side, depth)
    wide, down = side * 2 ** max(0, -halved), max(0, halved)
    spots = cases.filter(_placed()).select(
        case_id, F.col("lon").cast("double").alias("case_lon"), F.col("lat").cast("double").alias("case_lat"), *by,
        *[F.floor(F.col(c) / F.lit(wide / 2**down)).alias(g) for g, c in (("_cx", "lon"), ("_cy", "lat"))],
    )
    tiles = cut_lineage(_with_counts(spots, by), "count-cells")
    small = at_most(tiles, constants.BROADCAST_ROWS)
    cells = tiles.withColumns({p: F.call_function("shiftright", F.col(c), F.lit(down)) for p, c in (("_px", "_cx"), ("_py", "_cy"))})

    # by their bytes all places would be put into one task
    tasks = math.ceil((facilities.count() + 1) / MET_PLACES)

    def meet(places: DataFrame) -> DataFrame:
        state = (
            places.repartition(tasks, "lon", "lat").withColumns({"_spread": F.xxhash64("lon", "lat"), "_o": F.explode(offset_array(neighbours()))})
            .withColumns({p: F.floor(F.col(c) / F.lit(wide)) + F.col(f"_o.{d}") for p, c, d in (("_px", "lon", "dx"), ("_py", "lat", "dy"))})
            .drop("_o")
        )
        return _judged(cell_join(state, cells, ["_px", "_py"], "_spread", small), degrees)

    places = facilities.filter(_placed()).select(F.col("lon").cast("double"), F.col("lat").cast("double")).distinct()
    if nearest:
        # a case is at most as far as the farthest corner of any tile's box
        places = cut_lineage(meet(places).groupBy("lon", "lat").agg(F.min("_hi").alias("_bound")), "count-bounds")
    else:
        places = places.withColumn("_bound", F.lit(-1.0))
    met = meet(places)
    whole = met.filter("NOT _rim").select("lon", "lat", F.col("_last").alias("_ring"), F.explode("_counts").alias("_c"))
    whole = whole.groupBy("lon", "lat", "_ring", *[F.col(f"_c.{c}").alias(c) for c in by]).agg(F.sum("_c._n").alias("_n"))
    # a tile that is left closed at its bound is a single spot, and the bound is its distance
    close = F.col("_lo") < F.col("_bound")
    opened = met.filter(F.col("_rim") | close).select(
        "lon", "lat", "_cx", "_cy", "_n", "_rim", F.when(close, F.col("_bound")).otherwise(-1.0).alias("_bound"), F.lit(True).alias("_open")
    )
    pairs = cut_lineage(opened, "count-pairs")
    counted = _counted(pairs, spots, degrees, by, case_id)
    total = counted.unionByName(whole, allowMissingColumns=True)
    if nearest:
        bounds = places.filter(F.col("_bound") <= F.lit(reach)).select("lon", "lat", F.lit(0).cast("bigint").alias("_n"), F.col("_bound").alias("_near"))
        total = total.unionByName(bounds, allowMissingColumns=True)
    return total.groupBy("lon", "lat", "_ring", *by).agg(F.sum("_n").alias("_n"), F.min("_near").alias("_near"))


def _counted(pairs: DataFrame, spots: DataFrame, degrees: list[float], by: tuple[str, ...], case_id: str) -> DataFrame:
    """The places of each opened tile with its cases, in portions that a task can hold: counts add up over portions."""
    load = pairs.groupBy("_cx", "_cy").agg(F.count(F.lit(1)).alias("_places"), F.max("_n").alias("_cases"))
    portions = {p: F.ceil(F.col(c) / F.lit(float(most))).cast("int") for p, c, most in (("_pp", "_places", PLACES), ("_cp", "_cases", CASES))}
    load = cut_lineage(load.withColumns(portions), "count-tiles")
    work = load.agg(F.sum(F.col("_places") * F.sqrt("_cases")) + F.count(F.lit(1)) * TILE_WORK, F.sum(F.col("_pp") * F.col("_cp"))).first()
    tasks = max(1, min(math.ceil((work[0] or 0) / TASK_WORK), work[1] or 0))
    load = load.select("_cx", "_cy", "_pp", "_cp")
    if at_most(load, constants.BROADCAST_ROWS):
        load = F.broadcast(load)
    key = ["_cx", "_cy", "_ps", "_cs"]

    def dealt(df: DataFrame, by_hash: tuple[str, str, list[str]], copied: tuple[str, str], columns: list[str]) -> DataFrame:
        name, parts, spread = by_hash
        salted = df.join(load, ["_cx", "_cy"]).withColumn(name, F.pmod(F.xxhash64(*spread), F.col(parts)).cast("int"))
        copies = salted.withColumn(copied[0], F.explode(F.sequence(F.lit(0), F.col(copied[1]) - F.lit(1))))
        return copies.select(*key, *columns).repartition(tasks, *key)

    left = dealt(pairs, ("_ps", "_pp", ["lon", "lat"]), ("_cs", "_cp"), ["lon", "lat", "_rim", "_bound"])
    right = dealt(spots, ("_cs", "_cp", [case_id]), ("_ps", "_pp"), ["case_lon", "case_lat", *by])
    kinds = [("lon", "double"), ("lat", "double"), ("_ring", "integer"), *[(c, spots.schema[c].dataType) for c in by], ("_n", "long"), ("_near", "double")]
    schema = StructType()
    for name, kind in kinds:
        schema = schema.add(name, kind)
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(tile_counter(degrees, by), schema)


def _with_counts(spots: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """The occupied cells with the box of their cases, their number `_n`, and the numbers per value of `by` as a list."""
    corners = [f(c).alias(n) for f, c, n in (
        (F.min, "case_lon", "x0"), (F.min, "case_lat", "y0"), (F.max, "case_lon", "x1"), (F.max, "case_lat", "y1"),
    )]
    per_value = spots.groupBy("_cx", "_cy", *by).agg(*corners, F.count(F.lit(1)).alias("_n"))
    return _joined(per_value, F.struct(*by, "_n"))


def _joined(per_value: DataFrame, entry: Column) -> DataFrame:
    return per_value.groupBy("_cx", "_cy").agg(*_hull(), F.sum("_n").alias("_n"), F.collect_list(entry).alias("_counts"))


def _hull() -> list[Column]:
    return [f(c).alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))]


def _judged(met: DataFrame, degrees: list[float]) -> DataFrame:
    """Pairs of a place and a tile in reach: the gaps `_lo` and `_hi` to its nearest and farthest corner, the ring `_last` of the latter, and
    whether its cases can lie in different rings (`_rim`)."""
    lon, lat = F.col("lon"), F.col("lat")
    dx = F.greatest(F.col("x0") - lon, lon - F.col("x1"), F.lit(0.0))
    dy = F.greatest(F.col("y0") - lat, lat - F.col("y1"), F.lit(0.0))
    wide = F.greatest(F.abs(lon - F.col("x0")), F.abs(lon - F.col("x1")))
    high = F.greatest(F.abs(lat - F.col("y0")), F.abs(lat - F.col("y1")))
    pairs = met.withColumns({"_lo": F.sqrt(dx * dx + dy * dy), "_hi": F.sqrt(wide * wide + high * high)})
    pairs = pairs.filter(F.col("_lo") <= F.lit(degrees[-1])).withColumn("_last", _ring(F.col("_hi"), degrees))
    return pairs.withColumn("_rim", ~_ring(F.col("_lo"), degrees).eqNullSafe(F.col("_last")))


def _ring(dist: Column, degrees: list[float]) -> Column:
    """Number of the first radius that holds a distance, null beyond the last."""
    result = F.when(dist <= F.lit(degrees[0]), F.lit(0))
    for k, radius in enumerate(degrees[1:], 1):
        result = result.when(dist <= F.lit(radius), F.lit(k))
    return result

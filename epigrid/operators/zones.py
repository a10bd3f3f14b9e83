"""Risk zones: buffers around cases, their union, its area and its outline.

All buffers of a zone are copies of one regular polygon, moved to the cases and scaled by the tier's radius. Two facts
make the union an ordinary grouped aggregate:

* An edge of one copy is never longer than a chord of another copy parallel to it. So each other buffer covers either
  nothing of the edge or a piece that reaches one of its ends, and what is left free of an edge is a single interval from
  the largest covered end on its left to the smallest on its right: a `max` and a `min`.
* The area is half the sum over the free pieces of (distance of the piece's line from the origin) x (length of the piece),
  a plain `sum`.

No group is collected and no interval list is sorted. Dense places are thinned on grid cells first, see `thin`.
"""

import math
from functools import cache

from pyspark.sql import Column, DataFrame, Window, functions as F

from epigrid.constants import APOTHEM, HALF_SIDE, NORMALS, RISK_TIERS, SIDES, SQKM_PER_SQDEG, UNIT_AREA, VERTICES
from epigrid.functions.geo import round_half_up, to_degrees
from epigrid.functions.rings import RING_TYPE, buffer_ring, let, ring_wkt
from epigrid.operators.joins import neighbours, offset_array
from epigrid.session import cut_lineage

ALL_EDGES = (1 << SIDES) - 1
# Cell side of the first thinning step in radii, the factor between steps, and how far a cell looks for cover.
THIN_SIDE, THIN_FACTOR, THIN_REACH = 0.25, 4, 5
# Largest number of thinning steps; cells of a row that are judged together; a place is crowded if so many of them are occupied, or
# if one holds more centres than this.
THIN_STEPS, BLOCK, FILLED, CROWDED = 8, 32, 16, 16
# Step of the displacement table in radii, and its reach in steps.
MOVE_SIDE, MOVE_REACH = 0.125, 9
# Two edges closer than this many radii count as on one line.
TOUCH = 1e-9
# Ends of pieces closer than half of this many radii are one point.
NEAR = 1e-6
# Side of the cells that rays from holes pass, in radii: about as long as the longest piece.
RAY_SIDE = 0.2


def tiers_of(df: DataFrame, tiers=RISK_TIERS) -> DataFrame:
    """One copy of each row per tier, with `risk_tier` and `radius_meters`: one scan serves all tiers."""
    options = F.array(*[F.struct(F.lit(t).alias("risk_tier"), F.lit(r).alias("radius_meters")) for t, r in tiers])
    return df.withColumn("_tier", F.explode(options)).select("*", "_tier.*").drop("_tier")


def cross_tiers(df: DataFrame, tiers: DataFrame) -> DataFrame:
    """The same for tiers that come as a table: it is packed into one value, which every row explodes."""
    options = tiers.agg(F.collect_list(F.struct("risk_tier", "radius_meters"))).scalar()
    return df.withColumn("_tier", F.explode(options)).select("*", "_tier.*").drop("_tier")


def case_buffers(cases: DataFrame, metres: float) -> DataFrame:
    """Add each case's buffer polygon as `ring`."""
    return cases.withColumn("ring", buffer_ring(F.col("lon"), F.col("lat"), to_degrees(F.lit(float(metres)))))


def tier_buffers(cases: DataFrame) -> DataFrame:
    """One buffer per case and tier."""
    radius = to_degrees(F.col("radius_meters"))
    return tiers_of(cases).withColumn("ring", buffer_ring(F.col("lon"), F.col("lat"), radius))


@cache
def covered_edges(low_x: float, low_y: float, high_x: float, high_y: float) -> int:
    """Bit mask of the edges of a unit buffer that lie strictly inside its copy, for all moves in the given box.

    The moves that cover an edge form a convex set, so the four corners of the box decide.
    """
    mask = 0
    for k in range(SIDES):
        ends = (VERTICES[k], VERTICES[(k + 1) % SIDES])
        depth = max(
            (x - mx) * nx + (y - my) * ny
            for x, y in ends
            for mx in (low_x, high_x)
            for my in (low_y, high_y)
            for nx, ny in NORMALS
        )
        if depth < APOTHEM - TOUCH:
            mask |= 1 << k
    return mask


def thin(centres: DataFrame, group: list[str], steps: int = THIN_STEPS) -> DataFrame:
    """Drop centres in crowded places whose buffer is surely inside the union of the others.

    `centres` are distinct centres with `_id`, `_r` (the same within a group) and `_hidden`, a mask of covered edges. An
    occupied grid cell of a crowded place knows from those around it which edges of its buffers are covered. If all are, one
    centre of the cell represents it: the strip between a dropped buffer and the representative's lies, edge by edge,
    inside a buffer of another cell. Cells at the rim keep their centres, and the next step repeats this with
    cells a quarter as wide. The union stays exactly the same, while the number of buffers left depends on the occupied
    area and its outline and no longer on the number of cases, and no buffer has more others around it than a place just short of
    crowded has. Every step is stored; the steps end when no crowded rim cell is left.
    """
    todo = centres
    kept = []
    for step in range(steps):
        side = THIN_SIDE / THIN_FACTOR**step
        width = F.col("_r") * F.lit(side)
        placed = todo.withColumns({"_gx": F.floor(F.col("lon") / width), "_gy": F.floor(F.col("lat") / width)})
        blocks = cut_lineage(_crowded_blocks(placed, group), "thin-blocks")
        if blocks.isEmpty():
            break
        judged = cut_lineage(_thin_step(placed, _judged_cells(blocks, group, side), ["_gx", "_gy", *group]), "thin")
        kept.append(judged.filter("NOT _crowded").select(*centres.columns))
        todo = judged.filter("_crowded").select(*centres.columns)
    result = todo
    for part in kept:
        result = result.unionByName(part)
    return result


def _crowded_blocks(placed: DataFrame, group: list[str]) -> DataFrame:
    """The crowded places: runs of 32 cells of a row of which FILLED are occupied, or one holds over CROWDED centres. `_bits` marks the
    occupied cells, and `_cells` lists them with their number of centres and the least id."""
    cells = placed.groupBy("_gx", "_gy", *group).agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_rep"))
    at = F.col("_gx").bitwiseAND(F.lit(BLOCK - 1).cast("bigint")).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), at)
    block = F.floor(F.col("_gx") / F.lit(BLOCK)).alias("_bx")
    listed = F.collect_list(F.struct("_gx", at.alias("_at"), "_n", "_rep")).alias("_cells")
    blocks = cells.groupBy(*group, "_gy", block).agg(F.bit_or(bit).alias("_bits"), F.max("_n").alias("_most"), listed)
    return blocks.filter((F.bit_count("_bits") >= FILLED) | (F.col("_most") > CROWDED)).drop("_most")


def _judged_cells(blocks: DataFrame, group: list[str], side: float) -> DataFrame:
    """The cells of the blocks with `_n`, `_rep` and `_mask`, the edges that the occupied cells around cover.

    A block tells the rows of cells around which of its cells are occupied, as the bits of one number, and not each cell each other.
    """
    reach = THIN_REACH
    rows = F.array(*[F.lit(dy).cast("bigint") for dy in range(-reach, reach + 1)])
    bits = F.col("_bits")
    # What a block sees of itself and of the blocks to its left and right: bit 0 is `reach` cells to the left of its first cell.
    seen = [
        (0, F.call_function("shiftleft", bits, F.lit(reach))),
        (1, F.call_function("shiftleft", bits.bitwiseAND(F.lit((1 << reach) - 1).cast("bigint")), F.lit(BLOCK + reach))),
        (-1, F.call_function("shiftright", bits, F.lit(BLOCK - reach))),
    ]
    views = F.array(*[F.struct((F.col("_bx") - F.lit(away)).alias("_bx"), view.alias("_view")) for away, view in seen])
    told = (
        blocks.select(*group, "_gy", F.explode(views).alias("_v"))
        .filter("_v._view != 0")
        .select(*group, "_gy", "_v.*", F.explode(rows).alias("_dy"))
        .withColumn("_gy", F.col("_gy") - F.col("_dy"))
        .groupBy(*group, "_gy", "_bx")
        .agg(*[F.bit_or(F.when(F.col("_dy") == dy, F.col("_view"))).alias(f"_row{dy + reach}") for dy in range(-reach, reach + 1)])
    )
    masks = []
    for dy in range(-reach, reach + 1):
        around = F.call_function("shiftright", F.coalesce(f"_row{dy + reach}", F.lit(0).cast("bigint")), F.col("_c._at"))
        cover = [covered_edges((dx - 1) * side, (dy - 1) * side, (dx + 1) * side, (dy + 1) * side) for dx in range(-reach, reach + 1)]
        # two halves of the row, each looked up as a whole
        for first in (0, reach + 1):
            part = cover[first : first + reach + 1]
            table = [_union(m for k, m in enumerate(part) if chosen >> k & 1) for chosen in range(1 << len(part))]
            chosen = F.call_function("shiftright", around, F.lit(first)).bitwiseAND(F.lit(len(table) - 1).cast("bigint"))
            masks.append(F.element_at(F.expr("array(" + ", ".join(f"{m}L" for m in table) + ")"), chosen.cast("int") + F.lit(1)))
    mask = masks[0]
    for more in masks[1:]:
        mask = mask.bitwiseOR(more)
    cells = blocks.join(told, [*group, "_gy", "_bx"], "left").withColumn("_c", F.explode("_cells"))
    return cells.select(*group, "_gy", "_c._gx", "_c._n", "_c._rep", mask.alias("_mask"))


def _union(masks) -> int:
    result = 0
    for mask in masks:
        result |= mask
    return result


def _thin_step(placed: DataFrame, judged: DataFrame, cell: list[str]) -> DataFrame:
    """One thinning step. `_crowded` marks the centres for the next one."""
    mask = F.coalesce("_mask", F.lit(0).cast("bigint"))
    inner = mask == F.lit(ALL_EDGES).cast("bigint")
    kept = [c for c in placed.columns if c not in ("_gx", "_gy", "_hidden")]
    return (
        placed.join(judged, cell, "left")
        .filter(~inner | (F.col("_id") == F.col("_rep")))
        .select(
            *kept,
            F.col("_hidden").bitwiseOR(mask).alias("_hidden"),
            (F.col("_n").isNotNull() & ~inner).alias("_crowded"),
        )
    )


def distinct_centres(cases: DataFrame, group: list[str]) -> DataFrame:
    """The distinct places of each zone (a value of `group` and `radius_meters`), stored so that their ids are fixed."""
    centres = (
        cases.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull())
        .select(*group, "radius_meters", "lon", "lat")
        .distinct()
        .withColumns(
            {
                "_id": F.monotonically_increasing_id(),
                "_r": to_degrees(F.col("radius_meters")),
                "_hidden": F.lit(0).cast("bigint"),
            }
        )
    )
    return cut_lineage(centres, "centres")


def free_edges(centres: DataFrame, group: list[str], steps: int = THIN_STEPS) -> DataFrame:
    """The outline of each zone's merged buffers, one row per edge with a free piece.

    Columns: the zone, `_r` (its radius in degrees), the centre `lon`, `lat` with its `_id`, the edge number `k`, and the
    free piece from `t0` to `t1`, measured along the edge from its middle in radii.
    """
    zone = [*group, "radius_meters"]
    left = thin(centres, zone, steps)
    covers = (
        left.withColumn("_o", F.explode(offset_array(neighbours())))
        .withColumns(
            {
                "_gx": F.floor(F.col("lon") / _reach()) + F.col("_o.dx"),
                "_gy": F.floor(F.col("lat") / _reach()) + F.col("_o.dy"),
            }
        )
        .select(*zone, "_gx", "_gy", F.col("_id").alias("_b"), F.col("lon").alias("b_lon"), F.col("lat").alias("b_lat"))
    )
    return _cut_edges(_open_edges(left, covers, zone), covers, zone)


def _reach() -> Column:
    """An edge and a buffer can only meet if the edge's middle and the buffer's centre are this close."""
    return F.col("_r") * F.lit((1 + HALF_SIDE) * (1 + 1e-9))


def _moved() -> tuple[Column, Column]:
    """The other buffer's displacement in radii."""
    return (F.col("b_lon") - F.col("lon")) / F.col("_r"), (F.col("b_lat") - F.col("lat")) / F.col("_r")


def _open_edges(left: DataFrame, covers: DataFrame, zone: list[str]) -> DataFrame:
    """One row per edge that no single neighbour hides. The displacement of a neighbour picks a mask from a table."""
    open_centre = F.col("_hidden") != F.lit(ALL_EDGES).cast("bigint")
    placed = left.filter(open_centre).withColumns(
        {"_gx": F.floor(F.col("lon") / _reach()), "_gy": F.floor(F.col("lat") / _reach())}
    )
    ix, iy = (F.floor(d / F.lit(MOVE_SIDE)) + F.lit(MOVE_REACH) for d in _moved())
    span = 2 * MOVE_REACH
    # A merge join spills. Without the hint a broadcast could be chosen from a size estimate that ignores the ninefold copies.
    masked = (
        placed.hint("merge")
        .join(covers, ["_gx", "_gy", *zone])
        .filter(ix.between(0, span - 1) & iy.between(0, span - 1))
        .withColumn("_mask", F.element_at(_move_masks(), (ix * F.lit(span) + iy + F.lit(1)).cast("int")))
    )
    directions = F.array(
        *[
            F.struct(F.lit(k).alias("k"), F.lit(nx).alias("nx"), F.lit(ny).alias("ny"))
            for k, (nx, ny) in enumerate(NORMALS)
        ]
    )
    return (
        masked.groupBy(*zone, "_r", "lon", "lat", "_id")
        # A centre is its own neighbour, so none is lost here.
        .agg(F.bit_or(F.col("_hidden").bitwiseOR(F.col("_mask"))).alias("_hidden"))
        .filter(open_centre)
        .withColumn("_e", F.explode(directions))
        .select("*", "_e.*")
        .filter(F.call_function("shiftright", F.col("_hidden"), F.col("k")).bitwiseAND(F.lit(1).cast("bigint")) == 0)
        .drop("_e", "_hidden")
    )


def _cut_edges(edges: DataFrame, covers: DataFrame, zone: list[str]) -> DataFrame:
    """Cut each open edge against the buffers near its middle."""
    placed = edges.withColumns(
        {
            "_gx": F.floor((F.col("lon") + F.col("_r") * F.lit(APOTHEM) * F.col("nx")) / _reach()),
            "_gy": F.floor((F.col("lat") + F.col("_r") * F.lit(APOTHEM) * F.col("ny")) / _reach()),
        }
    )
    # Displacement along the edge's normal and along the edge itself.
    dx, dy = _moved()
    met = (
        placed.hint("merge")
        .join(covers, ["_gx", "_gy", *zone])
        .withColumns({"_up": F.col("nx") * dx + F.col("ny") * dy, "_along": F.col("nx") * dy - F.col("ny") * dx})
        .filter((F.col("_up") >= F.lit(-TOUCH)) & (F.col("_up") <= F.lit(2 * APOTHEM + TOUCH)))
        .withColumn("_half", _half_chord(F.lit(APOTHEM) - F.col("_up")))
    )
    # Two edges on one line and facing the same way: the lower centre owns the shared stretch.
    hides = (F.col("_up") > F.lit(TOUCH)) | (F.col("_b") < F.col("_id"))
    low, high = F.col("_along") - F.col("_half"), F.col("_along") + F.col("_half")
    half = F.lit(HALF_SIDE)
    cut = met.withColumns(
        {
            "_t0": F.when(hides & (low <= -half) & (high > -half), F.least(high, half)).otherwise(-half),
            "_t1": F.when(hides & (high >= half) & (low < half), F.greatest(low, -half)).otherwise(half),
        }
    )
    # The edge's own buffer is among those that it meets, so every edge has a row.
    free = cut.groupBy(*zone, "_r", "lon", "lat", "_id", "k").agg(
        F.max("_t0").alias("t0"),
        F.min("_t1").alias("t1"),
    )
    return free.filter(F.col("t1") - F.col("t0") > F.lit(TOUCH))


def edge_normal() -> tuple[Column, Column]:
    """Outward normal of edge `k`."""
    return tuple(F.element_at(F.lit([n[axis] for n in NORMALS]), F.col("k") + F.lit(1)) for axis in (0, 1))


def outline(cases: DataFrame, group: list[str]) -> DataFrame:
    """The merged buffers' outline as pieces from (`from_x`, `from_y`) to (`to_x`, `to_y`), zone on the left."""
    return _piece_ends(free_edges(distinct_centres(cases, group), group), [*group, "radius_meters", "lon", "lat", "k"])


def rings(cases: DataFrame, group: list[str]) -> DataFrame:
    """The outline as closed rings: the zone, `ring`, the position `seq` in it and the vertex `x`, `y`.

    A piece is followed by the one that starts where it ends. Where several pieces end and start at one point, each is followed
    by the first one clockwise from where it came from, which keeps every corner of the merged area whole. Following is then
    done by doubling: each round joins every piece with the one that it points to and doubles the distance, and carries the
    smallest piece number seen and how far away it is. The rounds end when no number changes; there are about log2 of the
    longest ring. Pieces spread evenly over the tasks whatever the size of a zone or ring.
    """
    zone = [*group, "radius_meters"]
    free = free_edges(distinct_centres(cases, group), group)
    numbered = free.withColumn("_piece", F.col("_id") * F.lit(SIDES) + F.col("k"))
    pieces = cut_lineage(_piece_ends(numbered, [*zone, "_r", "_piece", "k"]), "pieces")
    # A piece ends where its follower starts, to the last bit: a ray can't slip through, nor an end stand out.
    closed = pieces.drop("_r", "k", "to_x", "to_y").join(_followers(pieces, zone), "_piece")
    closed = cut_lineage(closed, "closed-pieces")
    chain = closed.select(
        "_piece", "_jump", F.col("_piece").alias("_first"), F.lit(0).cast("bigint").alias("_steps"), F.lit(True).alias("_moved")
    )
    chain, span = cut_lineage(chain, "chain"), 1
    wrong = pieces.join(chain.groupBy(F.col("_jump").alias("_piece")).agg(F.count(F.lit(1)).alias("_n")), "_piece", "left")
    wrong = wrong.filter(F.coalesce("_n", F.lit(0)) != 1).select(*zone, "from_x", "from_y").first()
    if wrong:
        raise ValueError(f"the outline does not close at {tuple(wrong)}")
    while not chain.filter("_moved").isEmpty():
        ahead = chain.select(
            F.col("_piece").alias("_jump"),
            F.col("_jump").alias("_far"),
            F.col("_first").alias("_first2"),
            F.col("_steps").alias("_steps2"),
        )
        lower = F.col("_first2") < F.col("_first")
        chain = cut_lineage(
            chain.join(ahead, "_jump").select(
                "_piece",
                F.col("_far").alias("_jump"),
                F.least("_first", "_first2").alias("_first"),
                F.when(lower, F.col("_steps2") + F.lit(span)).otherwise(F.col("_steps")).alias("_steps"),
                lower.alias("_moved"),
            ),
            "chain",
        )
        span *= 2
    # A piece that is n steps before the first one stands n places before the end.
    return closed.drop("_jump").join(chain, "_piece").select(
        *zone,
        F.col("_first").alias("ring"),
        F.when(F.col("_steps") == 0, F.lit(None)).otherwise(-F.col("_steps")).alias("seq"),
        F.col("from_x").alias("x"),
        F.col("from_y").alias("y"),
        "to_x",
        "to_y",
    )


def _followers(pieces: DataFrame, zone: list[str]) -> DataFrame:
    """(_piece, _jump, to_x, to_y): the piece that follows each, and where that one starts. Ends and starts meet on a grid far finer than any piece, and far coarser
    than rounding; starts are copied to the cells that are half a cell away."""
    fine = F.col("_r") * F.lit(NEAR)

    def cell(value: Column) -> Column:
        return F.floor(value / fine)

    steps = F.array(F.lit(-0.5), F.lit(0.5))
    starts = (
        pieces.withColumn("_sx", F.explode(F.array_distinct(F.transform(steps, lambda d: cell(F.col("from_x") + d * fine)))))
        .withColumn("_sy", F.explode(F.array_distinct(F.transform(steps, lambda d: cell(F.col("from_y") + d * fine)))))
        .select(*zone, "_sx", "_sy", F.col("_piece").alias("_jump"), F.col("k").alias("_k"), F.col("from_x").alias("_x"), F.col("from_y").alias("_y"))
    )
    ends = pieces.select(*zone, "_r", "_piece", "k", "to_x", "to_y", cell(F.col("to_x")).alias("_sx"), cell(F.col("to_y")).alias("_sy"))
    close = (F.abs(F.col("to_x") - F.col("_x")) <= fine / 2) & (F.abs(F.col("to_y") - F.col("_y")) <= fine / 2)
    # turn from where a piece came from, clockwise, in sides
    turn = (F.col("k") + F.lit(SIDES // 2 + SIDES - 1) - F.col("_k")) % SIDES
    met = ends.join(starts, [*zone, "_sx", "_sy"]).filter(close)
    follower = F.struct("_jump", F.col("_x").alias("to_x"), F.col("_y").alias("to_y"))
    return met.groupBy("_piece").agg(F.min_by(follower, F.struct(turn, "_jump")).alias("_f")).select("_piece", "_f.*")


def ring_summary(vertices: DataFrame, group: list[str]) -> DataFrame:
    """Per ring: its vertices and its signed area in square degrees; a hole runs clockwise and has a negative area."""
    origin = vertices.groupBy(*group, "radius_meters", "ring").agg(F.min("x").alias("_x"), F.min("y").alias("_y"))
    cross = (F.col("x") - F.col("_x")) * (F.col("to_y") - F.col("_y")) - (F.col("to_x") - F.col("_x")) * (
        F.col("y") - F.col("_y")
    )
    key = [*group, "radius_meters", "ring"]
    return (
        vertices.join(origin, key)
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("vertices"), (F.sum(cross) / F.lit(2.0)).alias("area_deg2"))
    )


def ring_texts(vertices: DataFrame, group: list[str]) -> DataFrame:
    """Each ring as polygon text, for export. One text is one value, so one ring has to fit into a row here; the vertex
    rows of `rings` have no such bound."""
    corner = F.struct(F.col("seq"), F.col("x"), F.col("y"))
    ordered = vertices.groupBy(*group, "radius_meters", "ring").agg(F.sort_array(F.collect_list(corner)).alias("_v"))
    points = F.transform("_v", lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y")))
    return ordered.withColumn("_v", F.concat(points, F.slice(points, 1, 1))).select(
        *group, "radius_meters", "ring", ring_wkt(F.col("_v")).alias("wkt")
    )


def zone_parts(vertices: DataFrame, group: list[str]) -> DataFrame:
    """Per zone its geometry `parts`: every outer ring with the holes in it. One geometry is one value, so one zone has to fit
    into a row here; the vertex rows of `rings` have no such bound.

    Rings start at their lowest vertex from the left, so the same zone always has the same text. A hole belongs to the smallest
    outer ring around it, which `hole_owners` finds without pairing holes with rings.
    """
    zone = [*group, "radius_meters"]
    corner = F.struct(F.col("seq"), F.col("x"), F.col("y"))
    ordered = vertices.groupBy(*zone, "ring").agg(F.sort_array(F.collect_list(corner)).alias("_v"))
    points = F.transform("_v", lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y")))

    def turned(p: Column) -> Column:
        first = F.array_position(p, F.array_min(p)).cast("int")
        around = F.concat(F.slice(p, first, F.size(p)), F.slice(p, F.lit(1), first - 1))
        return F.concat(around, F.slice(around, 1, 1))

    closed = ordered.select(*zone, "ring", let(points, turned).alias("_ring"))
    owners = hole_owners(vertices, group)
    owned = closed.join(owners.withColumnRenamed("hole", "ring"), [*zone, "ring"])
    held = owned.groupBy(*zone, F.col("outer").alias("ring")).agg(F.sort_array(F.collect_list("_ring")).alias("_holes"))
    outer = closed.join(owners.select(*zone, F.col("hole").alias("ring")), [*zone, "ring"], "left_anti")
    parts = outer.join(held, [*zone, "ring"], "left").withColumn(
        "_part", F.concat(F.array("_ring"), F.coalesce("_holes", F.array().cast(f"array<{RING_TYPE}>")))
    )
    return parts.groupBy(*zone).agg(F.sort_array(F.collect_list("_part")).alias("parts"))


def hole_owners(vertices: DataFrame, group: list[str]) -> DataFrame:
    """(zone, `hole`, `outer`): the outer ring that each hole lies in.

    From the leftmost vertex of a hole a ray runs to the left; the first outline piece on its way belongs to the outer ring, or to
    another hole of the same outer ring, which then answers. Pieces lie in the cells of a grid; the next occupied cell to the left is a
    running maximum along a row of cells, and only the pieces in it are looked at. A ray that crosses none of them there goes on from the next
    cell, one round for all rays. Pointers from hole to hole are followed by doubling. They can't run in a circle: a ray starts at the smallest x
    of all ends of its hole's pieces, and what it meets is smaller, so each ring reaches further left than the one before. Work grows with holes and pieces, not with
    their product, and a zone spreads over its rows of cells.
    """
    zone = [*group, "radius_meters"]
    side = to_degrees(F.col("radius_meters")) * F.lit(RAY_SIDE)

    def cell(value: Column) -> Column:
        return F.floor(value / side)

    sizes = ring_summary(vertices, group)
    holes = sizes.filter("area_deg2 < 0").select(*zone, "ring")
    x, y, to_x, to_y = (F.col(c) for c in ("x", "y", "to_x", "to_y"))
    spread = [
        (name, F.explode(F.sequence(cell(F.least(a, b)), cell(F.greatest(a, b))))) for name, a, b in (("_cx", x, to_x), ("_gy", y, to_y))
    ]
    pieces = vertices.select(*zone, "ring", "x", "y", "to_x", "to_y")
    for name, made in spread:
        pieces = pieces.withColumn(name, made)
    pieces = cut_lineage(pieces, "ray-pieces")
    ends = (F.struct(a.alias("x"), b.alias("y")) for a, b in ((x, y), (to_x, to_y)))
    first = vertices.join(holes, [*zone, "ring"]).groupBy(*zone, F.col("ring").alias("hole")).agg(F.min(F.least(*ends)).alias("_p"))
    ray = first.select(*zone, "hole", F.col("_p.x").alias("_px"), F.col("_p.y").alias("_py"))
    waiting = cut_lineage(ray.withColumns({"_cx": cell(F.col("_px")), "_gy": cell(F.col("_py"))}), "rays")
    occupied = pieces.select(*zone, "_cx", "_gy").distinct()
    along = Window.partitionBy(*zone, "_gy").orderBy("_cx", F.col("hole").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    # where the piece meets the height of the ray; the lower end of a piece counts as on it
    at = x + (F.col("_py") - y) * (to_x - x) / F.nullif(to_y - y, F.lit(0.0))
    at = F.least(F.greatest(at, F.least(x, to_x)), F.greatest(x, to_x))
    crossed = ((y <= F.col("_py")) != (to_y <= F.col("_py"))) & (F.col("_x") < F.col("_px")) & (cell(F.col("_x")) == F.col("_cx"))
    hits = []
    while not waiting.isEmpty():
        marked = occupied.unionByName(waiting, allowMissingColumns=True)
        next_cell = F.max(F.when(F.col("hole").isNull(), F.col("_cx"))).over(along)
        looked = cut_lineage(marked.withColumn("_cx", next_cell).filter("hole IS NOT NULL"), "rays")
        lost = looked.filter("_cx IS NULL").select(*zone, "_px", "_py").first()
        if lost:
            raise ValueError(f"no ring is around the hole at {tuple(lost)}")
        met = looked.join(pieces, [*zone, "_cx", "_gy"]).withColumn("_x", at).filter(crossed)
        nearest = met.groupBy(*zone, "hole").agg(F.max(F.struct("_x", "ring")).alias("_hit")).select(*zone, "hole", F.col("_hit.ring").alias("outer"))
        hits.append(cut_lineage(nearest, "ray-hits"))
        rest = looked.join(hits[-1], [*zone, "hole"], "left_anti")
        waiting = cut_lineage(rest.withColumn("_cx", F.col("_cx") - 1), "rays")
    if not hits:
        return ray.select(*zone, "hole", F.col("hole").alias("outer")).limit(0)
    found = hits[0]
    for more in hits[1:]:
        found = found.unionByName(more)
    inner = holes.select(*zone, F.col("ring").alias("outer"), F.lit(True).alias("_on"))
    found = cut_lineage(found.join(inner, [*zone, "outer"], "left").withColumn("_on", F.coalesce("_on", F.lit(False))), "owners")
    while not found.filter("_on").isEmpty():
        ahead = found.select(*zone, F.col("hole").alias("outer"), F.col("outer").alias("_far"), F.col("_on").alias("_further"))
        joined = found.join(ahead, [*zone, "outer"], "left")
        found = cut_lineage(
            joined.select(*zone, "hole", F.coalesce("_far", "outer").alias("outer"), F.coalesce("_further", F.lit(False)).alias("_on")), "owners"
        )
    return found.select(*zone, "hole", "outer")


def _piece_ends(free: DataFrame, columns: list[str]) -> DataFrame:
    nx, ny = edge_normal()
    reach = F.col("_r") * F.lit(APOTHEM)

    def at(t: str) -> tuple[Column, Column]:
        along = F.col("_r") * F.col(t)
        return F.col("lon") + reach * nx - along * ny, F.col("lat") + reach * ny + along * nx

    (from_x, from_y), (to_x, to_y) = at("t0"), at("t1")
    return free.select(
        *columns,
        from_x.alias("from_x"),
        from_y.alias("from_y"),
        to_x.alias("to_x"),
        to_y.alias("to_y"),
    )


def union_area(cases: DataFrame, group: list[str], steps: int = THIN_STEPS) -> DataFrame:
    """Area in square degrees of each zone's merged buffers (`group` and `radius_meters`), as `area_deg2`."""
    centres = distinct_centres(cases, group)
    free = free_edges(centres, group, steps)
    # Coordinates relative to a corner of all places: the terms of the sum nearly cancel far from the origin.
    x, y = (centres.agg(F.min(c)).scalar() for c in ("lon", "lat"))
    nx, ny = edge_normal()
    height = nx * (F.col("lon") - x) + ny * (F.col("lat") - y) + F.col("_r") * F.lit(APOTHEM)
    length = (F.col("t1") - F.col("t0")) * F.col("_r")
    return free.groupBy(*group, "radius_meters").agg((F.sum(height * length) / F.lit(2.0)).alias("area_deg2"))


def buffer_area(radius_deg: Column) -> Column:
    """Area of one buffer in square degrees."""
    return radius_deg * radius_deg * F.lit(UNIT_AREA)


def ring_areas(vertices: DataFrame, group: list[str]) -> DataFrame:
    """Area in square degrees of each zone from its rings, as `union_area` gives it from the cases."""
    return ring_summary(vertices, group).groupBy(*group, "radius_meters").agg(F.sum("area_deg2").alias("area_deg2"))


def risk_zones(located: DataFrame, region: str = "region_name", merged: DataFrame | None = None) -> DataFrame:
    """Per region and tier: distinct cases, naive and merged area in sq km, and the share saved by merging.

    `located` are cases with their region (one row per region that holds the case); `merged` are the zones' areas if they are known.
    """
    radius = to_degrees(F.col("radius_meters"))
    if merged is None:
        merged = union_area(tiers_of(located.select(region, "lon", "lat").distinct()), [region])
    counts = tiers_of(
        located.groupBy(region).agg(F.countDistinct("case_id").alias("case_count"), F.count(F.lit(1)).alias("_buffers"))
    )
    naive = F.col("_buffers") * buffer_area(radius) * F.lit(SQKM_PER_SQDEG)
    area = F.col("area_deg2") * F.lit(SQKM_PER_SQDEG)
    return merged.join(counts, [region, "radius_meters"]).select(
        region,
        "risk_tier",
        "radius_meters",
        "case_count",
        round_half_up(naive, 3).alias("naive_sq_km"),
        round_half_up(area, 3).alias("area_sq_km"),
        overlap_savings(area, naive).alias("overlap_savings_pct"),
    )


def overlap_savings(merged: Column, naive: Column) -> Column:
    """Percentage of area saved by merging; NULL if there is no area."""
    return round_half_up((F.lit(1.0) - merged / F.nullifzero(naive)) * F.lit(100.0), 1)


def wide_areas(zones: DataFrame, region: str = "region_name") -> DataFrame:
    """Merged area per region, one column per tier, from the risk-zone table."""
    areas = [
        round_half_up(F.max(F.when(F.col("risk_tier") == tier, F.col("area_sq_km"))), 2).alias(
            f"{tier.lower()}_zone_sq_km"
        )
        for tier, _ in RISK_TIERS
    ]
    return zones.groupBy(region).agg(F.max("case_count").alias("total_cases"), *areas)


@cache
def _move_table() -> tuple[int, ...]:
    steps = range(-MOVE_REACH, MOVE_REACH)
    s = MOVE_SIDE
    return tuple(covered_edges(i * s, j * s, (i + 1) * s, (j + 1) * s) for i in steps for j in steps)


def _move_masks() -> Column:
    """Edges hidden by a neighbour, for each square of displacements, column by column."""
    return F.expr("array(" + ", ".join(f"{mask}L" for mask in _move_table()) + ")")


def _half_chord(height: Column) -> Column:
    """Half the length of the unit buffer's chord parallel to an edge, at a signed height above the centre.

    The width is concave in the height, hence the smallest of the widths that the sides to one hand allow.
    """


    turns = [2 * math.pi * j / SIDES for j in range(1, SIDES // 2)]
    return F.least(*[(F.lit(APOTHEM) - height * F.lit(math.cos(a))) / F.lit(math.sin(a)) for a in turns])

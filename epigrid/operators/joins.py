"""Equi-joins on grid cells, safe against large sides and hot cells."""

from pyspark.sql import DataFrame, functions as F

from epigrid import constants


def at_most(df: DataFrame, rows: int) -> bool:
    """True if the table has no more than `rows` rows. Counts at most one row more than that."""
    return df.select(F.lit(1)).limit(rows + 1).count() <= rows


def cell_join(
    many: DataFrame, few: DataFrame, keys: list[str], spread_on: str, few_is_small: bool, load: DataFrame | None = None, tasks: int | None = None
) -> DataFrame:
    """Inner equi-join of a large table with a table of cells.

    With a small (counted) cell table the large side is streamed past a broadcast and never moves. Otherwise both sides
    are shuffled, and the rows of a hot key are spread by a hash of `spread_on`.
    """
    if few_is_small:
        return many.join(F.broadcast(few), keys)
    return salted_join(many, few, keys, spread_on, load, tasks)


def salted_join(
    many: DataFrame, few: DataFrame, keys: list[str], spread_on: str, load: DataFrame | None = None, tasks: int | None = None
) -> DataFrame:
    """Inner equi-join that splits keys with more than HOT_ROWS rows on the large side.

    The list of hot keys has at most rows / HOT_ROWS entries, so it is broadcast. The salt is a hash of a row's own
    key and not a random number: a recomputed task must put every row where it was before.

    `tasks` fixes the number of join tasks, for joins whose work is their pairs: by the bytes of their input they would be put into few.
    """
    hot_rows = constants.HOT_ROWS
    if load is None:
        load = many.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = load.filter(F.col("_n") > hot_rows).select(
        *keys, F.ceil(F.col("_n") / F.lit(float(hot_rows))).cast("int").alias("_parts")
    )
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    salted = many.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(spread_on), parts).cast("int")
    )
    copies = few.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), parts - F.lit(1)))
    )
    left, right = salted.drop("_parts"), copies.drop("_parts")
    if tasks:
        left, right = (side.repartition(tasks, *keys, "_salt") for side in (left, right))
    # A merge join spills. Without the hint a broadcast could be chosen from a size estimate that ignores the copies of a row.
    return left.hint("merge").join(right, [*keys, "_salt"]).drop("_salt")


def neighbours(reach: int = 1) -> list[tuple[int, int]]:
    """Offsets of a cell and the cells around it."""
    steps = range(-reach, reach + 1)
    return [(dx, dy) for dx in steps for dy in steps]


def offset_array(offsets: list[tuple[int, int]]):
    """Offsets as a literal array of struct<dx, dy>."""
    return F.array(
        *[F.struct(F.lit(dx).cast("bigint").alias("dx"), F.lit(dy).cast("bigint").alias("dy")) for dx, dy in offsets]
    )

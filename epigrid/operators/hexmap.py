"""Hexagon heatmaps: counts per cell, roll-up to larger cells, and sums over the cells around.

Cases are counted once on 64-bit keys, with a partial aggregate before the shuffle; larger cells and neighbourhoods add up those
counts and never see a case.
"""

from pyspark.sql import DataFrame, functions as F

from epigrid.constants import SEVERE
from epigrid.functions.geo import is_severe
from epigrid.functions.hexgrid import hex_key, hex_ring, hex_text, neighbours, parent_key
from epigrid.operators.scoring import count_if

# Distance from the centre of a cell to its corners, in degrees.
HEX_SIZE = 0.01


def hex_counts(cases: DataFrame, size: float = HEX_SIZE, by: tuple[str, ...] = (), x: str = "lon", y: str = "lat") -> DataFrame:
    """Cases and severe cases per hexagon `_hex` and the columns `by`; rows without coordinates are in no cell."""
    located = cases.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    keyed = located.withColumn("_hex", hex_key(F.col(x), F.col(y), size))
    return keyed.groupBy(*by, "_hex").agg(
        F.count(F.lit(1)).alias("case_count"), count_if(is_severe("severity", SEVERE)).alias("severe_count")
    )


def hex_heatmap(cases: DataFrame, size: float = HEX_SIZE, by: tuple[str, ...] = ()) -> DataFrame:
    """The same with the cell's name as `hex_id` and its polygon as `ring`."""
    counts = hex_counts(cases, size, by)
    return counts.withColumns({"hex_id": hex_text(F.col("_hex")), "ring": hex_ring(F.col("_hex"), size)}).drop("_hex")


def hex_rollup(counts: DataFrame, factor: int = 3, by: tuple[str, ...] = ()) -> DataFrame:
    """Counts of cells `factor` times as large; a cell belongs to the one that holds its centre."""
    parents = counts.withColumn("_hex", parent_key(F.col("_hex"), factor))
    return parents.groupBy(*by, "_hex").agg(
        F.count(F.lit(1)).alias("cells"), F.sum("case_count").alias("case_count"), F.sum("severe_count").alias("severe_count")
    )


def hex_neighbourhood(counts: DataFrame, reach: int = 1, by: tuple[str, ...] = ()) -> DataFrame:
    """Every occupied cell with the cases of all cells at most `reach` steps away, its own included, as `nearby_count`.

    Each cell sends its count to the cells around; only sums that arrive at an occupied cell are kept.
    """
    sent = counts.select(*by, F.explode(neighbours(F.col("_hex"), reach)).alias("_hex"), F.col("case_count").alias("_n"))
    received = sent.groupBy(*by, "_hex").agg(F.sum("_n").alias("nearby_count"))
    return counts.join(received, [*by, "_hex"])

"""Connected components of a link table, on Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from epigrid.session import cut_lineage


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that a link names; root is the smallest node of its component.

    Large-star and small-star steps in turn: each node links its larger, then its smaller neighbours to the smallest one.
    The rounds grow with the logarithm of the component size. Every round is stored in the folder of `spark.checkpoint.dir`,
    so a lost executor costs a read; the only thing the driver sees of a round is its row count and checksum.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    edges = cut_lineage(edges, "links")
    seen = _state(edges)
    while True:
        edges = cut_lineage(_small_star(_large_star(edges)), "links")
        now = _state(edges)
        if now == seen:
            break
        seen = now
    leaves = edges.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("root"))
    return leaves.union(leaves.select(F.col("root").alias("node"), "root").distinct())


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64(F.least("u", "v"), F.greatest("u", "v")) / 2**40
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark.cast("long"))).first())


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    near = _both(edges)
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return near.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    below = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = below.groupBy("u").agg(F.min("v").alias("m"))
    moved = below.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()

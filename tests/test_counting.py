"""Counts around facilities by cells against counts of pairs."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from epigrid.functions.geo import dist_deg
from epigrid.operators import counting

RADII = [500, 1000, 2000]


@pytest.fixture(scope="module")
def dense(spark):
    """40,000 cases around places on both sides of zero: a cloud, a third of them in one spot, and rows without coordinates."""
    spread = [((F.xxhash64("id", F.lit(k)) % 100_000) / 100_000.0) * 0.03 for k in (1, 2)]
    cases = spark.range(40_000).select(
        F.col("id").alias("case_id"),
        F.when(F.col("id") % 3 == 0, 0.004).when(F.col("id") % 1001 == 1, None).when(F.col("id") % 1003 == 1, float("nan")).otherwise(spread[0]).alias("lon"),
        F.when(F.col("id") % 3 == 0, -0.003).when(F.col("id") % 1007 == 1, None).otherwise(spread[1]).alias("lat"),
        F.when(F.col("id") % 50 == 0, None).otherwise(F.element_at(F.array(F.lit("DF"), F.lit("DHF"), F.lit("DSS")), (F.col("id") % 3 + 1).cast("int"))).alias("severity"),
    )
    places = spark.range(60).select(
        F.col("id"),
        F.when(F.col("id") % 20 == 7, None).otherwise(((F.col("id") * 37) % 50 - 25) * 0.0015).alias("lon"),
        F.when(F.col("id") == 3, float("nan")).otherwise(((F.col("id") * 17) % 50 - 25) * 0.0015).alias("lat"),
    )
    # a place listed twice, one on the spot itself, and one far from every case
    extra = spark.createDataFrame([(100, 0.0, 0.0), (101, 0.0, 0.0), (100, 0.0, 0.0), (102, 0.004, -0.003), (103, 3.0, 3.0)], "id long, lon double, lat double")
    return places.unionByName(extra), cases


def summed(df, *by):
    near = F.min("_near") if "_near" in df.columns else F.lit(None)
    return df.groupBy("id").agg(
        *[F.sum(F.when(F.col("_ring") == k, F.col("_n")).otherwise(0)).alias(f"r{k}") for k in range(3)],
        F.sum(F.when(F.col("severity") == "DSS", F.col("_n") * (F.col("_ring") + 1)).otherwise(0)).alias("weighed"),
        near.alias("near"),
    )


@pytest.fixture(scope="module")
def expected(dense):
    """Every pair of a place and a case, compared one by one."""
    places, cases = dense
    away = dist_deg("p.lon", "p.lat", "c.lon", "c.lat")
    pairs = places.alias("p").crossJoin(F.broadcast(cases.alias("c"))).withColumn("_near", away)
    ring = F.when(away <= 500 / 111000.0, 0).when(away <= 1000 / 111000.0, 1).when(away <= 2000 / 111000.0, 2)
    pairs = pairs.withColumns({"_ring": ring, "_n": F.lit(1)}).filter("_ring IS NOT NULL")
    return rows(summed(pairs.select("p.id", "severity", "_ring", "_n", "_near")), "id", "r0", "r1", "r2", "weighed", "near")


@pytest.mark.parametrize("depth", [None, 0, 1, 3, 4])
def test_counts_equal_those_of_pairs(dense, expected, depth):
    found = summed(counting.ring_counts(*dense, RADII, by=("severity",), depth=depth))
    assert rows(found, "id", "r0", "r1", "r2", "weighed", "near") == expected


def test_counts_without_the_nearest(dense, expected):
    found = summed(counting.ring_counts(*dense, RADII, by=("severity",), nearest=False, depth=3))
    columns = ["id", "r0", "r1", "r2", "weighed"]
    assert rows(found, *columns) == [e[:5] for e in expected]


def test_shuffled_and_salted_counts(dense, expected, monkeypatch):
    monkeypatch.setattr(counting.constants, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(counting.constants, "HOT_ROWS", 50)
    found = summed(counting.ring_counts(*dense, RADII, by=("severity",), depth=3))
    assert rows(found, "id", "r0", "r1", "r2", "weighed", "near") == expected


def test_few_pairs_are_made(dense, monkeypatch):
    """The pairs of places and cells, with the cases of opened cells, are under a fifth of the pairs that a plain join compares."""
    places, cases = dense
    made, keep = [], counting.cut_lineage

    def record(df, label):
        stored = keep(df, label)
        if label == "count-pairs":
            made.append(stored)
        return stored

    monkeypatch.setattr(counting, "cut_lineage", record)
    counting.ring_counts(places, cases, [2000], depth=None).count()
    tested = made[-1].filter("_open").agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    side = 2000 / 111000.0 * (1 + 1e-9)
    cells = lambda df: df.filter("lon IS NOT NULL AND lat IS NOT NULL").groupBy(
        F.floor(F.col("lon") / side).alias("x"), F.floor(F.col("lat") / side).alias("y")
    )
    around = cells(places.dropDuplicates(["lon", "lat"])).count().alias("a").join(
        cells(cases).count().alias("b"), (F.abs(F.col("a.x") - F.col("b.x")) <= 1) & (F.abs(F.col("a.y") - F.col("b.y")) <= 1)
    )
    plain = around.agg(F.sum(F.col("a.count") * F.col("b.count"))).first()[0]
    assert 5 * (tested + sum(p.count() for p in made)) < plain


def test_thin_cases_are_joined_as_pairs(small):
    assert counting.count_depth(small["cases"], 0.01) == 0
    nobody = small["cases"].filter("false")
    assert counting.count_depth(nobody, 0.01) == 0
    for depth in (None, 3):
        assert counting.ring_counts(small["schools"], nobody, [1000], by=("severity",), depth=depth).count() == 0
        assert counting.ring_counts(small["schools"].filter("false"), small["cases"], [1000], depth=depth).count() == 0
    with pytest.raises(ValueError):
        counting.ring_counts(small["schools"], small["cases"], [1000, 500])


def test_large_facilities_are_not_broadcast(spark, monkeypatch):
    """Facilities are copied ninefold, which a size estimate does not see: copies beyond the bound are joined by shuffle, in tasks for their pairs."""
    from epigrid import constants
    from epigrid.operators.proximity import within_distance

    facilities = spark.createDataFrame([(i, 100 + 0.001 * i, 13.0) for i in range(20)], "id long, lon double, lat double")
    cases = spark.createDataFrame([(i, 100 + 0.0005 * i, 13.001) for i in range(50)], "case_id long, lon double, lat double")
    near = within_distance(facilities, cases, 500)
    wanted = sorted((r["id"], r["case_id"]) for r in near.collect())
    monkeypatch.setattr(constants, "BROADCAST_ROWS", 100)  # 20 facilities, 180 copies
    monkeypatch.setattr(constants, "PAIR_ROWS", 10)
    near = within_distance(facilities, cases, 500)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("REPARTITION_BY_NUM") == 2
    assert wanted and sorted((r["id"], r["case_id"]) for r in near.collect()) == wanted

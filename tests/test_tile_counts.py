"""Counts by tiles: what is stored and shuffled, and how many tiles there are."""

from pyspark.sql import functions as F

from epigrid.operators import counting


def cloud(spark, count, spread):
    place = [100 + ((F.xxhash64("id", F.lit(k)) % 1_000_000) / 1e6) * spread for k in (1, 2)]
    return spark.range(count).select(F.col("id").alias("case_id"), place[0].alias("lon"), place[1].alias("lat"))


def test_a_place_meets_no_more_tiles_when_cases_grow(spark, monkeypatch):
    """Only pairs of places and tiles are stored, and four times the cases leave their number as it is."""
    made, keep = [], counting.cut_lineage

    def record(df, label):
        stored = keep(df, label)
        if label == "count-pairs":
            made.append(stored.count())
        return stored

    monkeypatch.setattr(counting, "cut_lineage", record)
    places = cloud(spark, 50, 0.3).withColumnRenamed("case_id", "id")
    met = []
    for cases in (40_000, 160_000):
        made.clear()
        found = counting.ring_counts(places, cloud(spark, cases, 0.3), [5_000, 10_000])
        assert found.agg(F.sum("_n")).first()[0] > 0
        met.append(sum(made))
    assert met[1] < 1.3 * met[0]


def test_tiles_are_few_unless_full(spark):
    cases = cloud(spark, 20_000, 1.0)
    for side, depth in ((0.5, 10), (0.05, 4)):
        halved = counting._halvings(cases, side, depth)
        tile = side / 2.0**halved
        cells = cases.groupBy(F.floor(F.col("lon") / tile), F.floor(F.col("lat") / tile)).count()
        assert cells.count() <= 1.3 * counting.FEW_TILES

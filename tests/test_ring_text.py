"""Texts made in batches against the texts of the engine."""

import math

import pyarrow as pa
from pyspark.sql import functions as F

import __spark_entry__ as contract
from epigrid.functions.ring_text import ring_texts, texts_of
from epigrid.functions.rings import RING_TYPE, ring_wkt


def test_ring_texts(spark):
    rings = [
        [(98.0, 13.0), (100.25, 13.5), (1.0000000005, 7.123456789), (98.0, 13.0)], [(-98.5, -0.5), (179.999999999, 89.9), (-98.5, -0.5)],
        [(12345678.123456789, 0.02), (9.9999999996, 99.9999999996)], [], None, [None, (1.0, 2.0)], [(None, 2.0), (3.0, 4.0)], [(100.0, 13.0)],
        [(math.nan, 2.0)], [(0.0, 5.0), (0.5, 1e-9)],
    ]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rings)], f"id int, ring {RING_TYPE}").repartition(2)
    both = df.select("id", ring_texts(F.col("ring")).alias("a"), ring_wkt(F.col("ring")).alias("b")).collect()
    assert [r["a"] for r in both] == [r["b"] for r in both] and sum(r["a"] is not None for r in both) > 6


def test_nothing_at_all():
    assert len(texts_of(pa.array([], pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))) == 0


def test_tier_buffers_format_in_batches(spark):
    plan = contract.queries()["q08_tier_buffers"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan

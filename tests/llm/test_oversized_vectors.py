"""Vectors that are finite but too large for the plain search are ranked and scored exactly."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from conftest import rows
from epigrid.llm import topk_search


def whole(v):
    return [math.floor(Fraction(x) * 256) for x in v]


def best(pairs, k, asked):
    out = []
    for i, q in pairs:
        if asked(i):
            scored = sorted((-sum(a * b for a, b in zip(whole(q), whole(v))), j) for j, v in pairs if j != i and len(v) == len(q))[:k]
            out += [(i, n + 1, j, -s if -(1 << 63) <= -s < 1 << 63 else None) for n, (s, j) in enumerate(scored)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("large", [float(1 << 20), -float(1 << 21), 2.0**52 + 1, 1e300, -1.7e308])
def test_one_oversized_vector(spark, large):
    pairs = [(k, [0.5, 0.25 * k]) for k in range(5)] + [(77, [0.5, large])]
    table = spark.createDataFrame(pairs, "vec_id long, embedding array<double>")
    got = rows(topk_search.nearest(table, F.col("id").isin(0, 3, 77), k=3), "query_id", "rank", "vec_id", "score")
    assert sorted(got, key=repr) == best(pairs, 3, lambda i: i in (0, 3, 77))


def test_many_oversized_vectors(spark, monkeypatch):
    """A third of the rows, with ties and scores on both sides of a long's ends, over several blocks."""
    monkeypatch.setattr(topk_search, "ROWS_PER_BLOCK", 40)
    monkeypatch.setattr(topk_search, "QUERIES_PER_BLOCK", 4)
    rng = random.Random(3)
    sizes = [1.0, 1.0, 1.0, 1e5, 3e7, 1e13, 1e200]
    pairs = [(k, [rng.uniform(-1, 1) * rng.choice(sizes) for _ in range(4)]) for k in range(150)]
    pairs += [(200 + k, [1e12, -1e12, 0.5, 2.0]) for k in range(8)] + [(300, [1e9] * 4), (350, [-1e9] * 4)]
    table = spark.createDataFrame(pairs, "vec_id long, embedding array<double>")
    got = rows(topk_search.nearest(table, F.col("id") % 10 == 0, k=5), "query_id", "rank", "vec_id", "score")
    assert sorted(got, key=repr) == best(pairs, 5, lambda i: i % 10 == 0)


def test_wide_vectors_of_great_length(spark):
    """Components below the limit whose products add up beyond a long."""
    pairs = [(k, [(500_000.0 + k) * (1 if k % 2 else -1)] * 2000) for k in range(6)]
    table = spark.createDataFrame(pairs, "vec_id long, embedding array<double>")
    got = rows(topk_search.nearest(table, F.col("id") == 0, k=5), "query_id", "rank", "vec_id", "score")
    assert sorted(got, key=repr) == best(pairs, 5, lambda i: i == 0)


def test_non_finite_vectors_take_no_part(spark):
    odd = [(5, [float("inf"), 1.0]), (6, [float("nan"), 1.0]), (7, [None, 1.0]), (8, None), (9, []), (None, [1e300, 1.0])]
    table = spark.createDataFrame([(k, [0.5, 0.25 * k]) for k in range(3)] + odd, "vec_id long, embedding array<double>")
    assert {r["vec_id"] for r in topk_search.nearest(table, F.col("vec_id") == 0, k=9).collect()} == {1, 2}

"""Capture times of the pages go into the records and the order of a URL's history."""

from datetime import datetime, timezone

from epigrid.llm import warc


def test_time_column(spark):
    at = lambda *t: datetime(*t, tzinfo=timezone.utc)
    captures = [
        (1, "http://a/", "x", at(2024, 5, 1, 0, 0, 1)), (2, "http://a/", "y", at(2023, 1, 1)), (3, "http://a/", "z", at(2024, 5, 1, 0, 0, 0, 250000)),
        (4, "http://a/", "w", None), (5, "http://a/", "v", at(1969, 12, 31, 23, 59, 59)),
    ]
    pages = spark.createDataFrame(captures, "page_id long, url string, html string, at timestamp")
    found = sorted(warc.archive(pages, time_column="at").collect(), key=lambda r: (r["part"], r["place"]))
    assert [(r["page_id"], r["captured"]) for r in found] == [
        (5, "19691231235959"), (4, "20200101000004"), (2, "20230101000000"), (3, "20240501000000250000"), (1, "20240501000001"),
    ]
    plain = sorted(warc.archive(pages).collect(), key=lambda r: (r["part"], r["place"]))
    assert [r["page_id"] for r in plain] == [1, 2, 3, 4, 5]

"""Exact top-k search (3) and WARC archives (10): against brute force."""

import gzip
import hashlib
import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import connect, difference
from conftest import rows
from epigrid.llm import topk_search, warc
from epigrid.llm.queries import EXACT_TOPK, op3_exact_topk
from epigrid.session import shared_folder

VECTORS = "vec_id long, embedding array<float>, label int, score long, rank int, r int, q int"


def vectors(spark, pairs):
    return spark.createDataFrame([(i, v, 0, 9, 9, 9, 9) for i, v in pairs], VECTORS)


def best(pairs, k):
    usable = [
        (i, np.floor(np.array(v, np.float32).astype(float) * 256).astype(np.int64))
        for i, v in pairs
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for i, q in {i: min((tuple(v) for j, v in usable if j == i)) for i, _ in usable if i % 50 == 0}.items():
        scored = sorted((-int(v @ np.array(q)), j) for j, v in usable if j != i and len(v) == len(q))[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    return sorted(out)


COLUMNS = ("query_id", "rank", "vec_id", "score")


@pytest.mark.parametrize("block", [8192, 100])
def test_topk(spark, block, monkeypatch):
    monkeypatch.setattr(topk_search, "ROWS_PER_BLOCK", block)
    monkeypatch.setattr(topk_search, "QUERIES_PER_BLOCK", max(3, block // 50))
    monkeypatch.setattr(topk_search, "QUERIES_AT_ONCE", 2)
    rng = np.random.default_rng(1)
    pairs = [(i, rng.normal(0, 0.3, 16).tolist()) for i in range(400)]
    pairs += [(400 + i, [0.5] * 16) for i in range(120)]  # ties and a hot vector
    pairs += [(1000, None), (1050, [float("nan")] + [0.0] * 15), (1100, [None] + [0.1] * 15), (1150, [float("inf")] * 16), (1200, [])]
    pairs += [(1250, [0.1, 0.2]), (1251, [0.3, -0.4]), (None, [0.1] * 16), (50, rng.normal(0, 0.3, 16).tolist()), (7, pairs[7][1])]
    found = topk_search.nearest(vectors(spark, pairs), F.col("id") % 50 == 0, k=5)
    assert rows(found, *COLUMNS) == best(pairs, 5)


def test_topk_of_few(spark):
    assert rows(topk_search.nearest(vectors(spark, [(0, [1.0, 2.0]), (1, [0.5, 0.5])]), F.col("id") % 50 == 0), *COLUMNS) == [(0, 1, 1, 256 * 128 + 512 * 128)]
    assert topk_search.nearest(vectors(spark, [(0, [1.0])]), F.col("id") % 50 == 0).count() == 0
    assert topk_search.nearest(vectors(spark, []), F.col("id") % 50 == 0).count() == 0
    big = [(0, [1e5, -1e5]), (1, [1e5, -1e5]), (2, [9e4, 1.0])]
    assert rows(topk_search.nearest(vectors(spark, big), F.col("id") % 50 == 0), *COLUMNS) == best(big, 5)


def test_lists_stop_early():
    """On clustered rows the reading stops before the lists end, and what can be best is still there."""
    rng = np.random.default_rng(2)
    data = rng.integers(-60, 60, (3000, 32))
    data[:20] += np.sign(data[:20]) * 40
    questions = data[:20] + rng.integers(-3, 3, (20, 32))
    lists = topk_search.Lists(data)
    read = []
    lists.order = type("Order", (), {"__getitem__": lambda self, s, o=lists.order: (read.append(s.stop), o[s])[1]})()
    found = lists.top(questions, np.full(20, -1), 5)
    assert max(read) <= 3000
    for q, near in zip(questions, found):
        scores = data @ q
        assert set(np.lexsort((np.arange(3000), -scores))[:5]) <= set(near.tolist())


def test_topk_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert difference(op3_exact_topk(spark, folder).toPandas(), connect(folder).execute(EXACT_TOPK).df()) is None


PAGES = "page_id long, url string, html string, digest string, size int, response long, file string"


def pages(spark, triples):
    return spark.createDataFrame([(i, u, h, "d", 1, 1, "f") for i, u, h in triples], PAGES)


@pytest.fixture(scope="module")
def captures():
    rng = random.Random(4)
    body = ["x" * 999, "y" * 1000, "é" * 500, "é" * 499, "", None, "z" * 300_000, "a\r\n\r\nb" * 300, "HTTP/1.1 404\r\n" * 100]
    urls = ["http://www.b.org/z?b=2&a=1#top", "https://a.b.org:8080/", "http://B.org/y", None, "not a url", "http://[bad", "http://é.net/ü\r\nX: 1", ""]
    return [(i, rng.choice(urls), rng.choice(body)) for i in range(260)] + [(900 + i, "http://hot.net/", "h" * 1500) for i in range(150)]


def decided(triples):
    same = {}
    for i, _, h in triples:
        same.setdefault((h or "").encode(), []).append(i)
    out = []
    for i, _, h in triples:
        data = (h or "").encode()
        last = max(same[data])
        revisit = len(data) >= 1000 and i != last
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", last if revisit else None))
    return sorted(out)


@pytest.mark.parametrize("per_file, per_range", [(5000, 50000), (7, 20)])
def test_archives(spark, captures, per_file, per_range, monkeypatch):
    monkeypatch.setattr(warc, "CAPTURES_PER_RANGE", per_range)
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    manifest = warc.write(pages(spark, captures), folder, records=per_file)
    assert manifest.agg(F.sum("records"), F.max("records")).first()[0] == len(captures)
    found = warc.merge(warc.read(manifest, folder)).toPandas()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, None if r.refers_to != r.refers_to else int(r.refers_to)) for r in found.itertuples()]
    assert sorted(got) == decided(captures)
    ordered = found.sort_values(["part", "place"])
    keys = list(zip(ordered.url_key, ordered.captured, ordered.page_id))
    assert keys == sorted(keys)
    name = found.file[0].replace("file://", "")
    path = f"{folder.removeprefix('file://')}/{name}"
    text = gzip.open(path).read()
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: ") and text.endswith(b"\r\n\r\n")


def test_archive_edges(spark):
    assert warc.archive(pages(spark, [])).count() == 0
    long = "p" * 2000
    found = rows(warc.archive(pages(spark, [(1, "u", long), (1, "u", long), (0, "u", long)])), "page_id", "record_type", "refers_to")
    assert found == [(0, "revisit", 1), (1, "response", None), (1, "response", None)]
    found = warc.archive(pages(spark, [(None, None, long), (None, "u", long)])).collect()
    assert [(r["page_id"], r["record_type"], r["refers_to"]) for r in found] == [(None, "response", None)] * 2
    found = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.archive(pages(spark, [(None, "u", long), (3, "u", long)])).collect()}
    assert found == {None: ("revisit", 3), 3: ("response", None)}


def test_damage_is_found():
    record = warc._record(5, "http://a/", "text" * 400, hashlib.sha1(b"text" * 400).hexdigest(), None)
    assert warc.parse(record)["page_id"] == 5
    with pytest.raises(ValueError, match="digest"):
        warc.parse(record.replace(b"texttext", b"textTEXT", 1))


def test_loser_tree():
    rng = random.Random(7)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted((rng.randint(0, 50), r) for _ in range(rng.randint(0, 30))) for r in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for run in runs for x in run)


def test_url_keys():
    assert warc.url_key("http://www.Example.org:80/A?b=2&a=1#x") == "org,example:80)/a?a=1&b=2"
    assert warc.url_key("https://news.example.org") == "org,example,news)/"
    assert warc.url_key(None) == "" and warc.url_key("http://[bad") == "http://[bad"

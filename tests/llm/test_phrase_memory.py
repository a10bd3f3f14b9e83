"""What the collocation tasks hold at once follows neither the phrases of a chunk, nor the chunks of a task, nor the languages."""

import tracemalloc
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from epigrid.llm import collocations
from epigrid.llm.collocations import Keys, QuotientFilter
from epigrid.session import cut_lineage


def chunk_of(words, length, seed=3):
    """Codes of a chunk with breaks and rare words, and the words' numbers across all chunks."""
    rng = np.random.default_rng(seed)
    number = np.append(0, rng.permutation(3 * words)[:words] + 1)
    number[rng.random(words + 1) < 0.1] = 0
    return (rng.zipf(1.2, length) % (words + 1)).astype(np.int32), number


@pytest.mark.parametrize("words, lead, block, bits", [(30, 3, 500, 0), (30, 0, 500, 0), (200, 2, 100_000, 0), (200, 10, 500, 17), (70_000, 10, 300, 0)])
def test_phrases_of_a_chunk_in_blocks(monkeypatch, words, lead, block, bits):
    monkeypatch.setattr(collocations, "PER_BLOCK", block)
    codes, number = chunk_of(words, 20_000)
    keys = Keys(max(3 * words, 1 << bits))
    expected = Counter()
    at = number[codes].tolist()
    for n in (2, 3, 4):
        expected.update((*at[i : i + n], *[0] * (4 - n)) for i in range(len(at) - n + 1) if all(at[i : i + n]))
    found, ranges = {}, []
    for r in (r for batch in collocations.chunk_filters(codes, number, keys, lead, 5) for r in batch.to_pylist()):
        f = QuotientFilter.unpack(keys, lead, r["first"], r["filter"])
        assert r["shard"] == 5 and (keys.order(f.high, f.low) == np.arange(f.size)).all()
        ranges.append(r["first"])
        for g, c in zip(keys.unpack(*keys.restore(f.high, f.low)).T.tolist(), f.counts.tolist()):
            assert tuple(g) not in found
            found[tuple(g)] = c
    assert found == expected
    assert ranges == sorted(set(ranges))  # a range is in one filter, whatever the blocks


def test_keys_with_a_shared_first_half_are_ordered():
    rng = np.random.default_rng(2)
    keys = Keys(1 << 20)
    high, low = rng.integers(0, 50, 5000).astype(np.uint64), rng.integers(0, 50, 5000).astype(np.uint64)
    high[:4000] = np.arange(4000) * 7
    order = keys.order(high, low)
    assert sorted(order.tolist()) == list(range(5000))
    assert [*zip(high[order].tolist(), low[order].tolist())] == sorted(zip(high.tolist(), low.tolist()))


@pytest.mark.parametrize("words", [5_000, 100_000])
def test_a_chunk_takes_little_memory(words):
    """Its phrases in one piece took 140 bytes a word and more, and over 65,535 frequent words far more."""
    codes, number = chunk_of(words, 1_500_000)
    keys = Keys(3 * words)
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in collocations.chunk_filters(codes, number, keys, 10, 0))
        assert rows and tracemalloc.get_traced_memory()[1] < 70 * len(codes)
    finally:
        tracemalloc.stop()


def test_many_languages_are_not_all_held(spark):
    rows = [(f"l{i % 40}", f"Some words, of text {i}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    table = collocations.chunks(docs, "lang", "text", 1000).cache()
    assert table.count() > 40 and table.agg(F.max(F.length("codes"))).first()[0] <= 4 * 1000
    found = table.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).groupBy("lang", "w.words").agg(F.sum("w.counts")).collect()
    expected = Counter((lang, w) for lang, t in rows for w in t.lower().replace(",", " ").split())
    assert {(r[0], r[1]): r[2] for r in found} == expected
    table.unpersist()


def test_a_chunk_of_different_words_ends(spark, monkeypatch):
    docs = spark.createDataFrame([("en", f"a{i} b{i} c{i}") for i in range(100)], "lang string, text string").coalesce(1)
    monkeypatch.setattr(collocations, "CHUNK_WORDS", 30)
    assert collocations._Chunk().row(1, "en").column("words").to_pylist() == [[]]
    parts = collocations.chunks(docs, "lang", "text").select("words").collect()
    assert len(parts) >= 9 and max(len(r["words"]) for r in parts) <= 33
    assert sorted(w for r in parts for w in r["words"]) == sorted(f"{c}{i}" for c in "abc" for i in range(100))


def test_a_row_group_holds_few_chunks(spark, monkeypatch):
    """A task's chunks were one row group and one page, which its writer and its reader held whole."""
    make, stored = collocations.chunks, {}

    def keep(df, label, *options):
        stored[label] = cut_lineage(df, label, *options)
        return stored[label]

    monkeypatch.setattr(collocations, "chunks", lambda docs, lang, text: make(docs, lang, text, 200))
    monkeypatch.setattr(collocations, "cut_lineage", keep)
    rows = [("en", f"new york city hall, word{i} new york city") for i in range(300)]
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(2)
    found = collocations.mine(docs, least=30).select("phrase", "a").collect()
    assert ("new york city", 600) in [tuple(r) for r in found]
    sizes = []
    for path in stored["word-chunks"].inputFiles():
        meta = pq.ParquetFile(path.removeprefix("file://")).metadata
        sizes += [meta.row_group(i).num_rows for i in range(meta.num_row_groups)]
    assert sum(sizes) >= 50 and max(sizes) <= 4
    assert "spark.sql.execution.arrow.maxBytesPerBatch" in spark.conf.getAll

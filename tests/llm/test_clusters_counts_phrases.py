"""Centroid clustering (11), token counts (12) and collocations (13): against brute force and the libraries."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from epigrid.llm import centroid_clusters, collocations, token_counts
from llm.conftest import frame, sentence

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model")


def plain_clusters(vectors, k, rounds):
    """vectors: (id, whole numbers); everything by Python integers."""
    order = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), q) for i, q in vectors if i is not None)
    centroids = [q for _, q in order[:k]]

    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, q in vectors:
            members[nearest(q)[1]].append(q)
        centroids = [[sum(c) // len(members[n]) for c in zip(*members[n])] if n in members else old for n, old in enumerate(centroids)]
    found = [(i, *nearest(q)) for i, q in vectors]
    sums = Counter()
    for _, d, n in found:
        sums[n] += d
    fit = lambda v: v if v < 1 << 63 else None
    broken = {n for _, d, n in found if fit(d) is None}
    total = None if broken else fit(sum(sums.values()))
    return sorted(
        (
            (i, n, fit(d), None if n in broken else fit(sums[n]), total, hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest())
            for i, d, n in found
        ),
        key=repr,
    )


def clusters(spark, rows, k, rounds, width, **more):
    table = spark.createDataFrame(
        [(i, v, 1, "c", 0.5) for i, v in rows], "vec_id long, embedding array<double>, cluster int, x string, distance double"
    )
    return sorted(map(tuple, centroid_clusters.cluster(table, k=k, rounds=rounds, width=width, **more).collect()), key=repr)


def whole(rows, width):
    """The vectors that take part, quantised."""
    return [(i, [centroid_clusters.whole(x) for x in v]) for i, v in rows if v and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]


@pytest.mark.parametrize("leading", [1, 3, 6])
def test_clusters(spark, leading):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(i % 7, 0.4) * (2.0 if j == 0 else 1.0) for j in range(6)]) for i in range(400)]
    rows += [(i, rows[5][1]) for i in (900, 900, 901)] + [(None, [0.5] * 6), (902, None), (903, [1.0] * 5), (904, [math.nan] * 6)]
    rows += [(905, [None] + [1.0] * 5), (906, [math.inf] * 6), (907, []), (908, [-0.0] * 6), (909, [-0.001] * 6)]
    assert clusters(spark, rows, 9, 4, 6, leading=leading) == plain_clusters(whole(rows, 6), 9, 4)


def test_clusters_of_huge_components(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(3)]) for i in range(60)]
    rows += [(100, [3e5, 0.0, 1.0]), (101, [1e30, -1e30, 0.5]), (102, [1e30, -1e30, 0.25]), (103, [1e307, 1.0, 1.0]), (104, [-1e9, 2e9, 0.1])]
    assert clusters(spark, rows, 12, 3, 3, leading=2) == plain_clusters(whole(rows, 3), 12, 3)


def test_few_vectors_and_ties(spark):
    same = [(i, [1.0, 1.0]) for i in range(5)] + [(7, [2.0, 1.0])]
    assert clusters(spark, same, 40, 5, 2) == plain_clusters(whole(same, 2), 40, 5)
    assert clusters(spark, [], 40, 5, 2) == [] and clusters(spark, [(1, None)], 40, 5, 2) == []


def test_filter_leaves_out_centroids():
    """With axes that fit the data most exact distances are saved."""
    rng = np.random.default_rng(1)
    q = (rng.integers(0, 20, (500, 1)) * 1000 * np.ones((1, 8)) + rng.integers(-20, 20, (500, 8))).astype(np.int32)
    axes = np.linalg.eigh((q.astype(float).T @ q))[1][:, ::-1]
    turned = q @ axes
    c = centroid_clusters.Centroids(tuple(tuple(int(1000 * k) for _ in range(8)) for k in range(20)), axes, 2)
    cluster, distance, measured = centroid_clusters.assign_narrow(q, turned[:, :2], np.sqrt((turned[:, 2:] ** 2).sum(1)), c)
    every = ((q[:, None].astype(np.int64) - np.array(c.values)[None]) ** 2).sum(2)
    assert (cluster == every.argmin(1)).all() and (distance == every.min(1)).all() and measured < 2 * len(q)


def library(name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda t: len(model.encode(t))
    tokenizer = Tokenizer.from_file(path)
    return lambda t: len(tokenizer.encode(t, add_special_tokens=False))


@pytest.mark.parametrize("name", FILES)
def test_split_texts_count_as_whole_ones(name):
    rng, whole_count = random.Random(5), library(name)
    counter = token_counts.counter(public_tokenizers.path(name))
    assert counter.units
    for k in range(400):
        text = "".join(rng.choice("abTHE't  's12\n\tingé́😀<|>!.½²ĲįİΣς\x85\xa0\x1c a b c▁") for _ in range(rng.randint(1, 200)))
        text = text if k % 7 else text[:50] + "a <|endoftext|> b <s> c" + text[50:]
        pieces = list(counter.pieces(text, 5))
        assert sum(counter.count(pieces)) == whole_count(text), text
        assert counter.lengths([text, None, "", text], 64).tolist() == [whole_count(text), 0, 0, whole_count(text)]


@pytest.mark.parametrize("name", FILES)
def test_token_counts(spark, edge_rows, name, monkeypatch):
    monkeypatch.setattr(token_counts, "PIECE_CHARACTERS", 200)
    count = library(name)
    rows = edge_rows + [(20, "word " * 2048), (21, "word " * 2049)]
    found = token_counts.counts(frame(spark, rows), public_tokenizers.path(name))
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    expected = [(i, len((t or "").encode()), count(t or ""), count(t or "") > 2048) for i, t in rows]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
    assert token_counts.counts(frame(spark, []), public_tokenizers.path(name)).count() == 0


def test_units_and_forgetting(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED_UNITS", 50)
    rng = random.Random(9)
    for name in FILES:
        counter, whole_count = token_counts._from_model(p) if (p := public_tokenizers.path(name)).endswith("model") else token_counts._from_json(p), library(name)
        for _ in range(5):
            texts = [sentence(rng, 80).replace("a", rng.choice([" ", "\n", "'s", ". "])) for _ in range(20)]
            assert counter.lengths(texts, 100).tolist() == [whole_count(t) for t in texts]
        counter.units = None
        assert counter.lengths([*texts, None]).tolist() == [*[whole_count(t) for t in texts], 0]


def test_balanced_runs():
    sizes = np.array([0, 5, 9, 1, 100, 1, 1, 0])
    runs = list(token_counts.balanced(sizes, 10))
    assert [x for a, b in runs for x in range(a, b)] == list(range(8)) and all(sizes[a:b].sum() <= 10 or b - a == 1 for a, b in runs)


def plain_phrases(rows, least, percent, top):
    fold = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(fold)):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
    often = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    gone = {
        (lang, w[a : a + m]) for (lang, w), v in often.items() for m in range(2, len(w)) for a in range(len(w) - m + 1)
        if 100 * v >= percent * f[lang, w[a : a + m]]
    }
    best = defaultdict(list)
    for (lang, w), a in often.items():
        if (lang, w) not in gone:
            score, k = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
            text = " ".join(w)
            best[lang].append((-score, -a, text.encode(), (text, a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score)))
    return sorted((lang, rank, *x[3]) for lang, v in best.items() for rank, x in enumerate(sorted(v)[:top], 1))


def phrase_rows():
    rng = random.Random(6)
    words = ["New", "york", "of", "the", "ünï", "x\x1cy", "a\x00b", "𝒳", "c", "d", "e"]
    rows = []
    for i in range(150):
        t = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "; "]) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice(["en", "en", "de", None, ""]), t + rng.choice(["", " new york city hall"])))
    return rows + [("en", None), ("en", ""), (None, None), ("fr", " \n\t."), ("en", "of the " * 3000), ("de", "z" * 5000)] + [("de", "one two three four")] * 40


@pytest.mark.parametrize("chunk, per_range, step", [(8 << 20, 1_000_000, 10), (300, 500, 2), (2000, 300, 10)])
def test_phrases(spark, monkeypatch, chunk, per_range, step):
    """One range, many ranges, and several merge steps give the same rows."""
    make = collocations.chunks
    monkeypatch.setattr(collocations, "chunks", lambda docs, lang, text: make(docs, lang, text, chunk))
    monkeypatch.setattr(collocations, "PER_RANGE", per_range)
    monkeypatch.setattr(collocations, "STEP_BITS", step)
    monkeypatch.setattr(collocations, "PER_RANKING", 50)
    rows = phrase_rows()
    docs = spark.createDataFrame([(lang, t, 1, "w") for lang, t in rows], "lang string, text string, chunk long, words string")
    found = sorted(map(tuple, collocations.mine(docs, least=5, top=25).collect()))
    assert found == plain_phrases(rows, 5, 80, 25)
    assert {r[0] for r in found} >= {"en", "de", "und", ""}


def test_phrases_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations.mine(docs).collect() == []
    assert collocations.mine(spark.createDataFrame([("en", "too few words")], "lang string, text string")).collect() == []


@pytest.mark.parametrize("words", [1, 3, 200, 70_000, (1 << 32) - 1])
def test_quotient_filters_lose_nothing(words):
    rng = np.random.default_rng(7)
    keys = collocations.Keys(words)
    grams = rng.integers(0, words + 1, (4, 5000))
    grams[:, ::3] = grams[:, [0]]
    high, low = keys.permute(*keys.pack(grams))
    assert (keys.unpack(*keys.restore(high, low)) == grams).all()
    lead = min(keys.half - 1, 3)
    parts = []
    for part in np.array_split(np.arange(5000), 4):
        order = part[keys.order(high[part], low[part])]
        raw = collocations.QuotientFilter(keys, 0, high[order], low[order], np.full(len(order), 100))
        dealt = collocations.QuotientFilter.merged([raw]).dealt(lead, 0).to_pylist()
        parts += [(r["first"], collocations.QuotientFilter.unpack(keys, lead, r["first"], r["filter"])) for r in dealt]
    got = Counter()
    for first in {k for k, _ in parts}:
        whole_range = collocations.QuotientFilter.merged([f for k, f in parts if k == first])
        assert (np.diff(whole_range.high.astype(object)) >= 0).all()
        numbers = keys.unpack(*keys.restore(whole_range.high, whole_range.low))
        got.update({tuple(g): c for g, c in zip(numbers.T.tolist(), whole_range.counts.tolist())})
    assert got == {g: 100 * c for g, c in Counter(map(tuple, grams.T.tolist())).items()}

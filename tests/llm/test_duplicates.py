"""Line dedup (2), substring dedup (4) and SimHash (9): against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import rows
from epigrid.llm import golay_simhash, line_dedup, substring_dedup
from epigrid.llm.components import connected_components
from llm.conftest import frame, sentence


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rng, text, n, letters="abcé"):
    out = list(text)
    for _ in range(n):
        k, kind = rng.randint(0, len(out)), rng.randint(0, 2)
        if kind == 0 or not out:
            out.insert(k, rng.choice(letters))
        elif kind == 1:
            out.pop(min(k, len(out) - 1))
        else:
            out[min(k, len(out) - 1)] = rng.choice(letters)
    return "".join(out)


def groups(items, linked):
    root = {x: x for x in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in items:
        for b in items:
            if a < b and linked(a, b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for x in items}


@pytest.mark.parametrize("threshold", [1, 2, 4])
def test_edit_distance(spark, threshold):
    rng = random.Random(threshold)
    pairs = [("", ""), ("a", ""), ("", "ab"), ("é", "e"), ("a" * 3000, "a" * 3000 + "b")]
    for _ in range(300):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(0, 70)))
        pairs.append((a, edited(rng, a, rng.randint(0, threshold + 2))))
    found = spark.createDataFrame(pairs, "a string, b string").withColumn("d", line_dedup.edit_distance(F.col("a"), F.col("b"), threshold))
    for r in found.collect():
        true = distance(r["a"], r["b"])
        assert r["d"] == true if true <= threshold else r["d"] > threshold


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_line_classes(spark, threshold, monkeypatch):
    rng = random.Random(2)
    base = [sentence(rng, 6) for _ in range(8)]
    lines = [edited(rng, rng.choice(base), rng.randint(0, 4)) for _ in range(150)] + [base[0]] * 60
    docs = [(i, "\n".join(lines[k : k + 5])) for i, k in enumerate(range(0, len(lines), 5))] + [(99, None), (98, "short\nshort"), (97, "")]
    at = {(i, k): line for i, t in docs for k, line in enumerate((t or "").split("\n")) if len(line) >= 12}
    different = sorted(set(at.values()))
    near = lambda a, b: abs(len(a) - len(b)) <= threshold and distance(a, b) <= threshold
    root = groups(different, near)
    degree = {a: sum(near(a, b) for b in different if b != a) for a in different}
    first = {}
    for place, line in sorted(at.items()):
        first.setdefault(root[line], place)
    wanted = sorted((*p, *first[root[line]], degree[line], p == first[root[line]]) for p, line in at.items())
    found = line_dedup.classes(frame(spark, docs), threshold, 12)
    columns = ("id", "at", "class_id", "class_at", "n_links", "kept")
    assert rows(found, *columns) == wanted
    monkeypatch.setattr(line_dedup, "BROADCAST_IDS", 0)
    assert rows(line_dedup.classes(frame(spark, docs), threshold, 12), *columns) == wanted


def test_line_plan_is_native(spark):
    docs = frame(spark, [(1, "one line that is long enough\nand another one of them")])
    plan = line_dedup.candidates(line_dedup._lines(docs, "doc_id", "text", 10))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan


def test_line_edges(spark, edge_rows):
    docs = frame(spark, edge_rows)
    cleaned = line_dedup.clean(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == len(edge_rows)
    kept = {(r["doc_id"], r["text"]) for r in cleaned.collect()}
    assert {(2, None), (3, ""), (None, None), (6, "x" * 5000)} <= kept
    assert line_dedup.clean(frame(spark, [])).count() == 0
    assert line_dedup.classes(frame(spark, [(1, "short"), (2, None)])).count() == 0
    twice = frame(spark, [(1, "the same line in two rows")] * 2 + [(2, "the same line in two rows\nand a line of its own")])
    assert Counter(r["text"] for r in line_dedup.clean(twice).collect()) == {"the same line in two rows": 2, "and a line of its own": 1}


def covered(docs, window):
    words = [(i, (t or "").encode().split()) for i, t in docs]
    seen = Counter(tuple(w[k : k + window]) for _, w in words for k in range(len(w) - window + 1))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone |= set(range(k, k + window))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(6)
    shared = [sentence(rng, n) for n in (35, 36, 60, 120)]
    docs = []
    for i in range(120):
        parts = [sentence(rng, rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared).split()
            cut = rng.randint(0, 5)
            parts += [" ".join(p[cut : len(p) - rng.randint(0, 5)]), sentence(rng, rng.randint(0, 20))]
        docs.append((i, rng.choice([" ", "\n", "\t "]).join(parts)))
    return docs + [(200, "of the " * 60), (201, "of " * 34), (202, "of " * 35), (203, "of " * 36), (204, "a b c d e f g " * 9)]


@pytest.mark.parametrize("crowded", [4000, 1, 0])
def test_substrings(spark, passages, edge_rows, crowded, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CROWDED", crowded)
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 400)
    docs = passages + [(i, t) for i, t in edge_rows if i != 8]
    found = sorted(map(tuple, substring_dedup.digests(frame(spark, docs)).collect()), key=repr)
    assert found == covered(docs, 35)


def test_substring_slices(spark, passages, monkeypatch):
    """Small slices and a short window; a slice never cuts a text."""
    monkeypatch.setattr(substring_dedup, "SLICE", 300)
    found = sorted(map(tuple, substring_dedup.digests(frame(spark, passages), window=12).collect()), key=repr)
    assert found == covered(passages, 12)


def test_substring_clean(spark):
    rng = random.Random(8)
    p = sentence(rng, 50)
    docs = frame(spark, [(1, f"own start\n{p} own end"), (2, p), (3, "left  as\tit is"), (4, None)])
    cleaned = substring_dedup.clean(docs)
    assert cleaned.columns == docs.columns
    assert rows(cleaned.where("text is not null"), "doc_id", "text") == [(1, "own start own end"), (2, ""), (3, "left  as\tit is")]
    assert substring_dedup.clean(frame(spark, [])).count() == 0 and substring_dedup.digests(frame(spark, [])).count() == 0


def test_automaton():
    rng = random.Random(9)
    for _ in range(30):
        texts = [[rng.randint(0, 2) for _ in range(rng.randint(3, 40))] for _ in range(6)]
        weights = [rng.randint(1, 2) for _ in texts]
        automaton = substring_dedup.Automaton()
        for t, n in zip(texts, weights):
            automaton.add(t, n)
        automaton.finish()
        seen = Counter()
        for t, n in zip(texts, weights):
            for k in range(len(t) - 2):
                seen[tuple(t[k : k + 3])] += n
        for t in texts:
            assert automaton.repeated(t, 3) == [k for k in range(len(t) - 2) if seen[tuple(t[k : k + 3])] > 1]


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_fingerprints(edge_rows):
    for _, text in edge_rows:
        assert golay_simhash.fingerprint(text) == plain_fingerprint(text)


def test_golay_code():
    table = golay_simhash.decoder()
    assert len(np.unique(table)) == 4096 and np.bincount(table).tolist() == [2048] * 4096
    words = np.random.default_rng(0).integers(0, 1 << 23, 500).astype(np.uint32)
    near = golay_simhash._near_codewords(words)
    assert {len(n) for n in near} <= {1, 6}
    for w, n in zip(words, near):
        assert all(table[w ^ np.uint32(1 << k)] in n for k in range(23))


def test_links(spark):
    """All pairs within four bits, each once: random fingerprints, and a dense group where most keys are shared."""
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    bits = set(rng.integers(0, 1 << 63, 300, dtype=np.uint64).tolist())
    for c in centres.tolist():
        for _ in range(25):
            x = c
            for k in rng.integers(0, 64, rng.integers(0, 6)).tolist():
                x ^= 1 << k
            bits.add(x)
    values = np.array(sorted(bits), np.uint64).view(np.int64)
    wanted = sorted(
        (int(a), int(b)) for a in values for b in values if a < b and np.bitwise_count(np.int64(a ^ b).view(np.uint64)) <= 4
    )
    nodes = spark.createDataFrame([(int(v),) for v in values], "bits long")
    assert rows(golay_simhash.links(nodes), "a", "b") == wanted


def test_near_duplicates(spark, edge_rows):
    rng = random.Random(12)
    docs = list(edge_rows)
    for i in range(30, 60, 6):
        text = sentence(rng, 200).split()
        for k in range(6):
            copy = list(text)
            copy[rng.randint(0, 199)] = "changed"
            docs.append((i + k, " ".join(copy) if k else " ".join(text)))
    found = golay_simhash.near_duplicates(frame(spark, docs)).collect()
    bits = sorted({plain_fingerprint(t) for _, t in docs})
    root = groups(bits, lambda a, b: bin(a ^ b).count("1") <= 4)
    least = {}
    for i, t in docs:
        r = root[plain_fingerprint(t)]
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    wanted = [(i, f"{plain_fingerprint(t):016x}", least[root[plain_fingerprint(t)]]) for i, t in docs]
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)
    assert golay_simhash.near_duplicates(frame(spark, [])).count() == 0
    stay = golay_simhash.representatives(frame(spark, docs))
    assert stay.columns == frame(spark, docs).columns
    assert stay.count() == len(set(root.values()))


def test_components(spark):
    """A long path with shuffled numbers, a star and a pair."""
    names = list(range(200))
    random.Random(3).shuffle(names)
    edges = list(zip(names, names[1:])) + [(1000, k) for k in range(1001, 1060)] + [(5000, 4000), (4000, 5000), (7, 7)]
    found = dict(rows(connected_components(spark.createDataFrame(edges, "a long, b long")), "node", "root"))
    assert found == {**{n: 0 for n in names}, **{k: 1000 for k in range(1000, 1060)}, 5000: 4000, 4000: 4000}

"""Toxicity (5), quality rules (6) and quality classifier (8): held-out accuracy, brute force, edges."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import rows
from epigrid.llm import quality_classifier, quality_rules, toxicity
from epigrid.llm.common import table
from epigrid.llm.features import labelled_sample
from epigrid.llm.queries import op5_toxicity, op6_quality_rules, op8_quality_classifier
from llm.conftest import frame, sentence

FOLDER = "/root/testdata/sf0.1"


def area(scores, truth):
    """Chance that a random positive scores above a random negative."""
    order = np.argsort(np.argsort(scores, kind="stable"))
    n = truth.sum()
    return (order[truth == 1].sum() - n * (n - 1) / 2) / (n * (len(truth) - n))


def held_out(spark, query, label):
    found = query(spark, FOLDER)
    labels = table(spark, FOLDER, "labels").select("doc_id", label)
    return found.where("held_out").join(labels, "doc_id").toPandas()


def test_toxicity_on_held_out_rows(spark):
    got = held_out(spark, op5_toxicity, "toxic")
    assert set(got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4)) == {2}
    assert area(got.score.to_numpy(), got.toxic.to_numpy()) > 0.98
    caught = got[got.toxic == 1].predicted.mean()
    assert caught > 0.88 and got[got.toxic == 0].predicted.mean() < 0.015  # some hold no word of theirs any more


def test_quality_on_held_out_rows(spark):
    got = held_out(spark, op8_quality_classifier, "quality")
    assert set(got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3)) == {1}
    assert area(got.score.to_numpy(), got.quality.to_numpy()) > 0.995
    assert got[got.quality == 1].predicted.mean() > 0.99 and got[got.quality == 0].predicted.mean() < 0.05


def test_offending_sentences(spark):
    rng = random.Random(1)
    texts, labels = [], []
    for k in range(400):
        parts = [sentence(rng, 8) for _ in range(6)]
        if k % 4 == 0:
            at = rng.randrange(6)
            parts[at] += f" {rng.choice(['zzgrub', 'zzfoul'])} {sentence(rng, 2)}"
        texts.append(". ".join(parts) + ".")
        labels.append(int(k % 4 == 0))
    model = toxicity.fit(texts[:300], labels[:300])
    for text, label in zip(texts[300:], labels[300:]):
        spans = [text.encode()[a:b].decode() for a, b, _ in model.locate(text)]
        assert bool(spans) == bool(label) and all("zz" in s for s in spans)
    docs = frame(spark, [(1, texts[0]), (2, None)])
    spans = dict(rows(toxicity.score(docs, model, spans=True), "doc_id", "sentences"))
    assert len(spans[1]) == 1 and spans[2] == []
    one_by_one = [model.locate(t) for t in [*texts[:40], None, "", "é zzfoul!"]]
    assert model.judge([*texts[:40], None, "", "é zzfoul!"], 0.3)[1] == one_by_one and one_by_one[-1][0][:2] == (0, 10)


def test_spans_of_the_query(spark):
    """Texts that are predicted toxic name a sentence, others none, and the spans lie in the text."""
    got = op5_toxicity(spark, FOLDER).join(table(spark, FOLDER, "documents").select("doc_id", "text"), "doc_id").collect()
    for row in got:
        assert bool(row["sentences"]) == bool(row["predicted"])
        assert all(0 <= s["start"] < s["end"] <= len(row["text"].encode()) for s in row["sentences"])


def test_dual_coordinate_descent_is_optimal():
    """At the optimum the duality gap is zero."""
    rng = np.random.default_rng(2)
    rows_, values = [np.arange(5)] * 60, list(rng.normal(size=(60, 5)))
    y = np.where(np.array([v[0] + 0.3 * v[1] for v in values]) > 0, 1.0, -1.0)
    y[:6] *= -1
    cost = np.full(60, 0.5)
    w = quality_classifier.dual_coordinate_descent(rows_, values, y, cost, 5, 2000, 1e-9)
    loss = lambda u: 0.5 * u @ u + sum(c * max(0, 1 - t * (u @ v)) for c, t, v in zip(cost, y, values))
    assert all(loss(w) <= loss(w + d) + 1e-6 for d in rng.normal(size=(500, 5)) * 0.05)


@pytest.mark.parametrize("module", [toxicity, quality_classifier])
def test_scores_of_edges(spark, module, edge_rows):
    rng = random.Random(3)
    texts = [sentence(rng, 30) + (" bad***" * 5 if k % 3 == 0 else "") for k in range(90)]
    model = module.fit(texts, [int(k % 3 == 0) for k in range(90)])
    found = rows(module.score(frame(spark, [r for r in edge_rows if r[0]]), model), "doc_id", "score", "predicted")
    assert len(found) == len([r for r in edge_rows if r[0]]) and all(0 <= s <= 1 for _, s, _ in found)
    assert module.score(frame(spark, edge_rows), model).count() == len(edge_rows)
    assert module.score(frame(spark, []), model).count() == 0
    one = module.fit(["a", "b"], [1, 1])
    assert [r["score"] for r in module.score(frame(spark, [(1, None)]), one).collect()] == [1.0]
    assert module.fit([], []).score(["x"]).tolist() == [0.0]


def test_sample_is_bounded_and_leaves_out(spark):
    docs = frame(spark, [(i, f"text {i}") for i in range(500)] + [(None, "no id"), (501, None)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(502)] + [(4, None), (6, 1), (None, 1)], "doc_id long, toxic int")
    found = labelled_sample(docs, labels, "toxic", 4, 2, 1000, "doc_id", "text").collect()
    wanted = {(i, 1 if i == 6 else i % 2) for i in range(500) if zlib.crc32(str(i).encode()) % 4 != 2}
    assert {(r["label_id"], r["label"]) for r in found} == wanted
    few = labelled_sample(docs, labels, "toxic", 4, 2, 20, "doc_id", "text")
    assert few.count() == 20 and rows(few, "label_id") == rows(few, "label_id")


def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    again = {k + d for k, w in enumerate(windows) if seen[w] > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(again)


def test_measures(spark, edge_rows):
    rng = random.Random(5)
    docs = edge_rows + [(100 + k, " ".join(rng.choice(["a", "b", "c\n", "#|", "é"]) for _ in range(rng.randint(0, 60)))) for k in range(300)]
    found = quality_rules.measures(frame(spark, docs))
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = sorted((tuple(r) for r in found.select(*columns).collect()), key=repr)
    assert got == sorted(((i, *plain_measures(t)) for i, t in docs), key=repr)


def test_expectation_maximisation():
    """Accuracies come back from votes drawn with known ones."""
    rng = random.Random(6)
    chance = {1: [(0.01, 0.1, 0.89)] * 5, -1: [(0.6, 0.2, 0.2)] * 5}
    seen = Counter()
    for _ in range(20000):
        side = 1 if rng.random() < 0.85 else -1
        seen[tuple(rng.choices((-1, 0, 1), p)[0] for p in chance[side])] += 1
    model = quality_rules.fit(sorted(seen.items()))
    assert abs(model.share_good - 0.85) < 0.06
    for k in range(5):
        assert model.chance[1][k][0] < 0.03 and model.chance[-1][k][0] > 0.3
    assert quality_rules.fit([]).share_good > 0


def test_rules_verdicts(spark, edge_rows):
    got = op6_quality_rules(spark, FOLDER).join(table(spark, FOLDER, "labels"), "doc_id").toPandas()
    judged = got[~got.base_failed]
    assert judged[judged.quality == 1].kept.mean() > 0.99 and judged[judged.quality == 0].kept.mean() < 0.15
    assert not got[got.base_failed].kept.any()
    base = (got.n_words < 50) | (100 * got.n_repeat_words > 50 * got.n_words)
    assert (base == got.base_failed).all()
    edges = quality_rules.judge(frame(spark, edge_rows))
    assert edges.count() == len(edge_rows) and edges.where("kept is null or base_failed is null").count() == 0
    assert quality_rules.judge(frame(spark, [])).count() == 0


def bayes(model, pattern):
    """Posterior by the plain products of the chances."""
    good, bad = model.share_good, 1 - model.share_good
    for k, vote in enumerate(pattern):
        good *= model.chance[1][k][vote + 1]
        bad *= model.chance[-1][k][vote + 1]
    return good / (good + bad)


def plain_fit(texts, rounds):
    """Expectation-maximisation text by text, with the pseudo-counts written out."""
    belief = [(t.count(1) + 0.5) / (t.count(1) + t.count(-1) + 1) for t in texts]
    for _ in range(rounds):
        share = (9 + sum(belief)) / (10 + len(texts))
        chance = {1: [], -1: []}
        for k in range(len(texts[0])):
            for side, start in ((1, (1, 1, 8)), (-1, (4, 1, 5))):
                seen = [n + sum(b if side == 1 else 1 - b for b, t in zip(belief, texts) if t[k] == v) for v, n in zip((-1, 0, 1), start)]
                chance[side].append(tuple(n / sum(seen) for n in seen))
        model = quality_rules.LabelModel(share, chance)
        belief = [bayes(model, t) for t in texts]
    return model


def test_posterior_against_plain_products(spark):
    """Fit and posterior on a small table against the text-by-text form; a weak rule's lone bad vote is overruled, agreeing rules are not."""
    rng = random.Random(8)
    good, bad = [(0.01, 0.04, 0.95)] * 4 + [(0.3, 0.1, 0.6)], [(0.8, 0.1, 0.1)] * 4 + [(0.35, 0.1, 0.55)]
    texts = [tuple(rng.choices((-1, 0, 1), p)[0] for p in (good if rng.random() < 0.9 else bad)) for _ in range(400)]
    model, plain = quality_rules.fit(sorted(Counter(texts).items()), rounds=25), plain_fit(texts, 25)
    assert abs(model.share_good - plain.share_good) < 1e-6
    rules = tuple(quality_rules.Rule(f"r{k}", "0", 1, 0) for k in range(5))
    every = sorted({*texts, (1, 1, 1, 1, -1), (-1, -1, 1, 1, 1)})
    voted = spark.createDataFrame(every, ", ".join(f"vote_r{k} int" for k in range(5)))
    got = voted.withColumn("p", model.posterior(rules)).collect()
    for row in got:
        assert abs(row["p"] - bayes(plain, tuple(row)[:5])) < 1e-4
    chances = {tuple(r)[:5]: r["p"] for r in got}
    assert chances[1, 1, 1, 1, -1] > 0.9 and chances[-1, -1, 1, 1, 1] < 0.5


def test_weak_rules_are_overruled(spark):
    """Verdicts are not those of a filter that every rule must pass, and the texts won back are good ones."""
    docs = table(spark, FOLDER, "documents")
    judged = quality_rules.judge(docs).where("not base_failed").join(table(spark, FOLDER, "labels"), "doc_id").toPandas()
    lone = judged[[c for c in judged.columns if c.startswith("vote_")]].eq(-1).any(axis=1)
    assert (judged.kept & lone).sum() > 0.2 * lone.sum()
    assert judged[judged.kept & lone].quality.mean() > 0.9
    assert judged[~lone].kept.all()


def test_rules_plan_is_native(spark):
    plan = quality_rules.judge(frame(spark, [(1, "some text")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

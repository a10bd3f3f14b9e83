"""The pipeline on a planted corpus, and its stages one by one against brute force."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from llm.conftest import sentence
from llm.test_duplicates import groups, plain_fingerprint


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean documents, junk, exact and near copies, and a passage of 60 words that three documents share."""
    rng = random.Random(21)
    clean = {i: "\n".join(sentence(rng, 40) + "." for _ in range(4)) for i in range(120)}
    passage = sentence(rng, 60)
    texts = dict(clean)
    for i in (3, 40, 77):
        texts[i] = f"{clean[i]}\n{sentence(rng, 10)} {passage} {sentence(rng, 10)}"
    texts |= {200 + i: clean[i] for i in range(10)}
    for i in range(10, 20):
        words = clean[i].split(" ")
        words[5] = "altered"
        texts[200 + i] = " ".join(words)
    texts |= {300 + i: " ".join(w + "***" for w in sentence(rng, 80).split()) for i in range(60)}
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = [(i, t, "en", "src0", len(t)) for i, t in texts.items()] + [(400, None, "en", "src0", 0), (401, "", "en", "src1", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i < 300), 0) for i in texts if i % 5]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, texts, passage


def test_stages(spark, corpus, tmp_path):
    folder, texts, passage = corpus
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if k < 4:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen[k] = docs.collect()
    after = [{r["doc_id"]: r["text"] for r in seen[k]} for k in range(4)]
    assert {i for i in texts if i < 300} <= set(after[0]) and not {i for i in after[0] if 300 <= i < 400}

    assert set(after[1]) == set(after[0])
    lines = Counter(line for t in after[1].values() for line in (t or "").split("\n") if len(line) >= 20)
    assert max(lines.values()) == 1 and set(lines) <= {x for t in texts.values() for x in t.split("\n")}
    assert all(after[1][i] == texts[i] for i in range(120)) and all(after[1][i] == "" for i in range(200, 210))
    assert all(r["n_chars"] == len(r["text"]) for r in seen[1] if r["text"] is not None)

    bits = {i: plain_fingerprint(t) for i, t in after[1].items()}
    root = groups(sorted(set(bits.values())), lambda a, b: bin(a ^ b).count("1") <= 4)
    least = {}
    for i in sorted(bits):
        least.setdefault(root[bits[i]], i)
    assert set(after[2]) == set(least.values()) and all(after[2][i] == after[1][i] for i in after[2])

    assert set(after[3]) == set(after[2])
    for i, text in after[3].items():
        if i in (3, 40, 77):
            assert passage.split()[30] not in text.split() and passage not in text
        else:
            assert text == after[2][i]
    packed = seen[4]
    assert {r["doc_id"] for r in packed} == set(after[3]) and all(r["offset"] + r["length"] <= 2048 for r in packed)


def test_run(spark, corpus):
    assert corpus_pipeline.run(spark, corpus[0]).count() > 0


def test_stages_on_an_empty_table(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet").limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, corpus[0]).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.count() == 0


def test_extra_columns_and_repeated_rows(spark, corpus, tmp_path):
    """Columns named like the operators' own go through every stage, and the packing reads past them."""
    extra = ["score", "predicted", "bits", "__score", "__predicted", "__scored_text", "__mark", "__gone", "__row", "__blob", "__ranges", "__null"]
    twice = (1, corpus[1][1])
    docs = spark.createDataFrame(
        [(*row, *range(len(extra))) for row in (twice, twice, (2, None), (3, corpus[1][5]))],
        "doc_id long, text string, " + ", ".join(f"{c} int" for c in extra),
    )
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, corpus[0]).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == ["doc_id", "text", *extra]
            assert {tuple(r[2:]) for r in docs.collect()} == {tuple(range(len(extra)))}
    assert {1, 3} <= {r["doc_id"] for r in docs.collect()} <= {1, 2, 3}

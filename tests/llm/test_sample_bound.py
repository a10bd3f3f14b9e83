"""The sample of the classifiers is bounded in rows and in characters where a labelled id is repeated."""

from epigrid.llm import features
from llm.conftest import frame


def test_repeated_ids(spark, monkeypatch):
    docs = frame(spark, [(1, f"text {k}") for k in range(300)] + [(k, "x" * 100) for k in range(2, 40)])
    labels = spark.createDataFrame([(k, 1) for k in range(1, 40)], "doc_id long, toxic int")
    found = features.labelled_sample(docs, labels, "toxic", 100, 101, 1000, "doc_id", "text").collect()
    assert sorted(r["label_id"] for r in found) == list(range(1, 40))
    monkeypatch.setattr(features, "SAMPLE_CHARACTERS", 1050)
    few = features.labelled_sample(docs, labels, "toxic", 100, 101, 1000, "doc_id", "text").collect()
    assert 10 <= len(few) <= 11 and sum(len(r["text"]) for r in few) <= 1050 and {len(r["text"]) for r in few if r["label_id"] > 1} == {100}
    monkeypatch.setattr(features, "SAMPLE_CHARACTERS", 1)
    assert features.labelled_sample(docs, labels, "toxic", 100, 101, 1000, "doc_id", "text").count() == 1

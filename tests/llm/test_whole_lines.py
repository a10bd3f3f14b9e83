"""Short lines in line deduplication: equal ones are classes too, in the module on request and in the pipeline's stage."""

from collections import Counter

import corpus_pipeline
from epigrid.llm import line_dedup
from llm.conftest import frame

DOCS = [
    (1, "Les.\na line that is long enough to compare\n\nok\n \t"),
    (2, "Les.\n\na line that is long enough to compare!\nLes.\nOk\n \t"),
    (3, "Les"),
    (4, "ok\nLes."),
    (5, None),
    (6, ""),
]


def test_short_lines(spark):
    found = line_dedup.classes(frame(spark, DOCS), 2, 20, short_equal=True).collect()
    text = dict(DOCS)
    at = {(i, k): x for i, t in text.items() for k, x in enumerate((t or "").split("\n")) if x.strip()}
    first = {}
    for place, line in sorted(at.items()):
        first.setdefault(line.rstrip("!"), place)
    assert {(r["id"], r["at"]): (r["class_id"], r["class_at"]) for r in found} == {p: first[x.rstrip("!")] for p, x in at.items()}
    assert Counter(r["n_links"] for r in found) == {0: len(at) - 2, 1: 2}


def test_pipeline_stage_takes_short_lines(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.lines(spark, docs, "").collect()}
    assert kept == {1: DOCS[0][1], 2: "\nOk\n \t", 3: "Les", 4: "", 5: None, 6: ""}

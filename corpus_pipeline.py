"""Corpus preparation in five stages, each on everything that its predecessor kept.

quality classifier: documents that it rejects go; line deduplication: later copies of a line go from the texts; SimHash
near-duplicates: one document of each group stays, linked where the fingerprints of their four-word shingles differ in four bits or
less; substring deduplication: repeated passages go from the texts; best-fit packing: the remaining documents become sequences. All but the last
return the columns of documents, with `n_chars` brought up to date. Documents that lose all their lines stay as empty ones until
the near-duplicate stage, which leaves one of them.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from epigrid.llm import golay_simhash, line_dedup, packing, quality_classifier, substring_dedup
from epigrid.session import cut_lineage, small_batches


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    model = quality_classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), parts=3, left_out=1)
    rest = tuple(c for c in docs.columns if c != "doc_id")
    prefix = "__"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    scored = quality_classifier.score(docs, model, threshold=0.5, keep=rest, prefix=prefix)
    return scored.where(F.col(f"{prefix}predicted") == 1).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(line_dedup.clean(docs, threshold=2, least_chars=20, short_equal=True)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return golay_simhash.representatives(docs, width=4).select(*docs.columns)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return _counted(substring_dedup.clean(docs, window=35)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    # the workers also serve the other stages, so they remember fewer units than the query of this operator alone
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), length=2048, added_tokens=True, remember=50_000)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_duplicates),
    ("substring dedup", passages),
    ("best-fit packing", pack),
]

#: The classifier, the edit join and the packing are beyond SQL; the stages are tested against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each returns is stored in the folder of `spark.checkpoint.dir` and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

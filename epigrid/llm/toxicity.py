"""Toxicity by multiple-instance learning.

Only documents are labelled. A document is a bag of sentences; each sentence gets a probability from the hashed words and
word beginnings in it, and a noisy-or over the sentences gives that of the document: it is toxic unless every sentence
fails to make it so. The weights are fitted to the document labels by gradient descent on the noisy-or likelihood, so
that the sentence probabilities afterwards also say where the offence lies.

The model is fitted on a bounded sample (`SAMPLE_ROWS` labelled rows, picked by a hash of the id); every text is scored
whole. Null and empty texts have one empty sentence and get its probability. Repeated rows are scored alike, null ids are
kept, further columns are not read, an empty table gives no rows, and without labels of both kinds the score
is the share of 1 and no sentence is named. An empty sentence is never named.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from epigrid.llm.common import slices
from epigrid.llm.features import Texts, buckets, labelled_sample

SAMPLE_ROWS = 4000
BITS = 20
#: Characters that are turned into features at once while fitting, which bounds the driver's memory.
FIT_CHARACTERS = 400_000
#: Word beginnings of these lengths in bytes count beside the whole word.
BEGINNINGS = (4, 5, 6, 7, 8)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?\n"]] = True


def bags(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, Texts]:
    """Feature and sentence of every feature that a sentence holds, the text of every sentence, and the texts' bytes."""
    block = Texts(texts)
    stops = np.flatnonzero(_STOP[block.data])  # every text ends with a line feed, so each has a sentence
    start, end = block.words(_LETTER)
    sentence = np.searchsorted(stops, start)
    columns = [buckets(block.hashes(start, end), BITS)]
    places = [sentence]
    for n in BEGINNINGS:
        longer = end - start > n
        columns.append(buckets(block.hashes(start[longer], start[longer] + n), BITS, salt=n))
        places.append(sentence[longer])
    held = np.unique(np.concatenate(places) << BITS | np.concatenate(columns))
    return held & ((1 << BITS) - 1), held >> BITS, block.doc_at(stops), block


def _sentences(feature, sentence, count, weights, bias):
    z = bias + np.bincount(sentence, weights=weights[feature], minlength=count)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _documents(p, doc, count):
    """Noisy-or: log of the chance that no sentence is toxic, and the chance that one is."""
    none = np.bincount(doc, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=count)
    return none, -np.expm1(none)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    constant: float | None = None

    def score(self, texts: list[str | None]) -> np.ndarray:
        return self.judge(texts)[0]

    def judge(self, texts: list[str | None], threshold: float | None = None) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
        """Score of every text, and with a threshold the spans of its offending sentences, from one pass.

        A span is the first byte of a sentence in its text, the byte after it, and the sentence's probability. Offending are the
        sentences whose own probability reaches the threshold, and the worst one of a text that reaches it by many small ones.
        """
        if self.constant is not None:
            return np.full(len(texts), self.constant), [[] for _ in texts]
        feature, sentence, doc, block = bags(texts)
        p = _sentences(feature, sentence, len(doc), self.weights, self.bias)
        score = _documents(p, doc, len(texts))[1]
        spans: list[list[tuple[int, int, float]]] = [[] for _ in texts]
        if threshold is not None and len(texts):
            stops = np.flatnonzero(_STOP[block.data])
            starts = np.concatenate([[0], stops[:-1] + 1])
            worst = np.maximum.reduceat(p, np.searchsorted(doc, np.arange(len(texts))))
            bar = np.where(score >= threshold, np.minimum(worst, threshold), threshold)
            for i in np.flatnonzero(p >= bar[doc]):
                begin, size = block.starts[doc[i]], block.sizes[doc[i]] - 1
                span = int(starts[i] - begin), int(min(stops[i] + 1 - begin, size)), float(p[i])
                if span[0] < span[1]:
                    spans[doc[i]].append(span)
        return score, spans

    def locate(self, text: str | None, threshold: float = 0.3) -> list[tuple[int, int, float]]:
        """Byte spans of the offending sentences of one text."""
        return self.judge([text], threshold)[1][0]


def fit(texts: list[str], labels: list[int], steps: int = 60, rate: float = 0.15, thrift: float = 1e-4) -> Model:
    """Gradient descent with momentum and per-weight scaling, all bags at once.

    Weights stay at or above zero and pay `thrift` for their size: a word can make a sentence offensive, but harmless words
    around it can't make up for it, and long sentences gather no chance from noise.
    """
    y = np.asarray(labels, float)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(1 << BITS, np.float32), 0.0, float(y.mean()) if len(y) else 0.0)
    size = 1 << BITS
    held, toxic = np.zeros(size), np.zeros(size)  # bags that hold a feature, and toxic ones of them
    blocks, seen = [], 0
    for part in slices(texts, FIT_CHARACTERS):
        feature, sentence, doc, _ = bags(part)
        once = np.unique(doc[sentence] << BITS | feature)
        held += np.bincount(once & (size - 1), minlength=size)
        truth = y[seen : seen + len(part)]
        toxic += np.bincount(once & (size - 1), weights=truth[once >> BITS], minlength=size)
        blocks.append((feature.astype(np.int32), sentence.astype(np.int32), doc, truth))
        seen += len(part)
    ratio = np.log((toxic + 0.5) / (y.sum() + 1)) - np.log((held - toxic + 0.5) / (len(y) - y.sum() + 1))
    known = np.flatnonzero(held >= 3)  # features of fewer bags say nothing about others
    number = np.full(size, -1, np.int32)
    number[known] = np.arange(len(known))
    for k, (feature, sentence, doc, truth) in enumerate(blocks):
        kept = number[feature] >= 0
        blocks[k] = number[feature[kept]], sentence[kept], doc, truth
    # start from the log ratios, weighted by how many bags they rest on; only features over chance start above zero
    weights = np.clip(ratio[known], 0, 4) * np.clip(toxic[known] / 20, 0, 1) * 0.5
    n = len(known)
    bias, m, v = -9.0, np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, steps + 1):
        g = np.zeros(n + 1)
        for feature, sentence, doc, truth in blocks:
            p = _sentences(feature, sentence, len(doc), weights, bias)
            none, any_ = _documents(p, doc, len(truth))
            pull = np.where(truth == 1, -np.exp(none) / np.maximum(any_, 1e-9), 1.0)
            slope = pull[doc] * p  # derivative by each sentence's logit
            g[:n] += np.bincount(feature, weights=slope[sentence], minlength=n)
            g[n] += slope.sum()
        g /= len(y)
        g[:n] += thrift
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-5)
        weights = np.maximum(weights - move[:n], 0)
        bias -= move[n]
    full = np.zeros(size, np.float32)
    full[known] = weights
    return Model(full, float(bias))


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", parts: int = 4, left_out: int = 2, rows: int = SAMPLE_ROWS,
    id_column: str = "doc_id", text_column: str = "text",
) -> Model:
    """Fit on labelled rows whose crc32(id as text) modulo `parts` is not `left_out`, at most `rows` of them."""
    sample = labelled_sample(docs, labels, label, parts, left_out, rows, id_column, text_column)
    found = sorted(sample.collect(), key=lambda r: (r["label_id"], r["text"]))[:rows]
    return fit([r["text"] for r in found], [r["label"] for r in found])


def score(
    docs: DataFrame, model: Model, threshold: float = 0.3, id_column: str = "doc_id", text_column: str = "text",
    spans: bool = False,
) -> DataFrame:
    """(id, score, predicted) of every text, and with `spans` the byte spans of the offending sentences."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS weights, whatever the corpus

    def run(batches):
        model = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            judged = [model.judge(part, threshold if spans else None) for part in slices(texts)]
            chance = np.concatenate([part[0] for part in judged]) if texts else np.zeros(0)
            columns = [batch.column(0), pa.array(chance), pa.array((chance >= threshold).astype(np.int32))]
            if spans:
                found = [[dict(zip(("start", "end", "probability"), s)) for s in each] for part in judged for each in part[1]]
                columns.append(pa.array(found, span_type))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))
    names = [id_column, "score", "predicted"] + ["sentences"] * spans
    picked = docs.select(F.col(id_column), F.col(text_column).cast("string"))
    schema = f"`{id_column}` {dict(picked.dtypes)[id_column]}, score double, predicted int"
    if spans:
        schema += ", sentences array<struct<start: bigint, end: bigint, probability: double>>"
    return picked.mapInArrow(run, schema)

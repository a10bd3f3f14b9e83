"""Quality classifier: naive Bayes support vectors.

A text becomes a set of n-gram indicators: words and word pairs (hashed), and n-grams of signs with the rate at which they
occur - three-character shapes (letter case, digits, punctuation) and back-references (a word or line that repeats an
earlier one), each as indicators "at least this share of the text". Every indicator is scaled by the log ratio of its
frequency in the two classes (naive Bayes with smoothing); a linear model with hinge loss is then fitted to the scaled,
length-normalised indicators by dual coordinate descent, and a logistic curve over its margin gives the score.

The model is fitted on a bounded sample (`SAMPLE_ROWS` labelled rows, picked by a hash of the id); every text is scored whole.
Null and empty texts hold no indicator and get the score of the intercept. Repeated rows are scored alike, null ids are kept,
further columns are not read, an empty table gives no rows, and without labels of both kinds the score is the share of 1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from epigrid.llm.common import fresh, giving_back, slices
from epigrid.llm.features import Texts, buckets, labelled_sample

SAMPLE_ROWS = 5000
#: Characters that are turned into indicators at once while fitting and while scoring, which bounds memory; the rates of a text take
#: as much as so many characters, so short texts count for more.
FIT_CHARACTERS = 400_000
SCORE_CHARACTERS = 300_000
TEXT_SHARE = 500
BITS = 18
SHARES = (0.0, 0.01, 0.03, 0.1, 0.3)

_WORD = np.ones(256, bool)
_WORD[list(b" \t\n\x0b\x0c\r")] = False
#: Shape of a byte: lower case, upper case, digit, blank, line end, and the signs one by one or as a group.
_SHAPE = np.full(256, 11, np.int64)
for _kind, _members in enumerate(
    ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r\x0b\x0c", "\n", ".?", ",;:", "!", "|", "*$%&#<>")
):
    _SHAPE[[ord(c) for c in _members]] = _kind
_SHAPE[128:] = 0
_KINDS = 12
_GRAMS = _KINDS**3
#: Back-references: same word as before, as the one before that, same pair as the last, same line as an earlier one.
_BACK = 4
_RATED = _GRAMS + _BACK
WIDTH = 2 * (1 << BITS) + _RATED * len(SHARES)


def indicators(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and indicator of everything that the texts hold, sorted, each once."""
    block = Texts(texts)
    n = block.count
    start, end = block.words(_WORD)
    doc = block.doc_at(start)
    h = block.hashes(start, end)
    pair_doc, pair = doc[:-1], h[:-1] * np.uint64(3) + h[1:]
    together = doc[:-1] == doc[1:]
    single = buckets(h, BITS)
    double = buckets(pair[together], BITS, salt=2) + (1 << BITS)
    found = [doc * WIDTH + single, pair_doc[together] * WIDTH + double]

    shape = _SHAPE[block.data]
    gram = (shape[:-2] * _KINDS + shape[1:-1]) * _KINDS + shape[2:]
    owner = np.repeat(np.arange(n), block.sizes)
    inside = owner[:-2] == owner[2:] if len(owner) > 2 else np.zeros(0, bool)
    counts = np.bincount((owner[:-2] * _RATED + gram)[inside], minlength=n * _RATED).reshape(n, _RATED).astype(float)
    rate = counts / np.maximum(block.sizes, 1)[:, None]
    words = np.maximum(np.bincount(doc, minlength=n), 1)
    for k, (gap, value) in enumerate(((1, h), (2, h), (2, h[:-1] * np.uint64(3) + h[1:]))):
        same = (value[gap:] == value[:-gap]) & (doc[: len(value)][gap:] == doc[: len(value)][:-gap])
        rate[:, _GRAMS + k] = np.bincount(doc[: len(value)][gap:][same], minlength=n) / words
    line_end = np.flatnonzero(block.data == 10)
    line_start = np.concatenate([[0], line_end[:-1] + 1])
    full = line_end - line_start > 1
    line_doc = block.doc_at(line_end[full])
    key = block.hashes(line_start[full], line_end[full]) + line_doc.astype(np.uint64)
    _, first = np.unique(key, return_index=True)
    again = np.ones(len(key), bool)
    again[first] = False
    rate[:, _GRAMS + 3] = np.bincount(line_doc[again], minlength=n) / np.maximum(np.bincount(line_doc, minlength=n), 1)
    for level, share in enumerate(SHARES):
        row, column = np.nonzero(rate > share)
        found.append(row * WIDTH + 2 * (1 << BITS) + level * _RATED + column)
    held = np.unique(np.concatenate(found))
    return held // WIDTH, held % WIDTH


def dual_coordinate_descent(
    rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: np.ndarray, width: int, rounds: int,
    tolerance: float = 1e-3,
) -> np.ndarray:
    """Weights of the linear hinge-loss model. Example i holds `values[i]` at `rows[i]`; its dual variable is at most `cost[i]`."""
    weights, alpha = np.zeros(width), np.zeros(len(y))
    square = np.array([float(v @ v) for v in values])
    order = np.random.default_rng(7)
    for _ in range(rounds):
        worst = 0.0
        for i in order.permutation(len(y)):
            slope = y[i] * float(weights[rows[i]] @ values[i]) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), cost[i])
            if new != alpha[i]:
                worst = max(worst, abs(new - alpha[i]) * square[i])
                weights[rows[i]] += (new - alpha[i]) * y[i] * values[i]
                alpha[i] = new
        if worst < tolerance:
            break
    return weights


@dataclass
class Model:
    """`weights` hold the class log ratios already; a text's margin is their sum over the root of `norm`'s, plus the bias."""

    weights: np.ndarray
    norm: np.ndarray
    bias: float
    steepness: float
    constant: float | None = None

    def margins(self, texts: list[str | None]) -> np.ndarray:
        row, held = indicators(texts)
        n = len(texts)
        total = np.bincount(row, weights=self.weights[held], minlength=n)
        length = np.sqrt(np.bincount(row, weights=self.norm[held], minlength=n))
        return total / np.maximum(length, 1e-9) + self.bias

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.steepness * self.margins(texts), -30, 30)))


def fit(texts: list[str], labels: list[int], smoothing: float = 1.0, cost: float = 1.0, rounds: int = 12) -> Model:
    y = np.where(np.asarray(labels) == 1, 1.0, -1.0)
    if not len(y) or y.min() == y.max():
        zero = np.zeros(1, np.float32)
        return Model(zero, zero, 0.0, 0.0, float((y > 0).mean()) if len(y) else 0.0)
    rows: list[np.ndarray] = []
    p, q = np.zeros(WIDTH), np.zeros(WIDTH)  # texts of either class that hold an indicator
    for part in slices(texts, FIT_CHARACTERS, TEXT_SHARE):
        row, held = indicators(part)
        good = y[len(rows) : len(rows) + len(part)][row] > 0
        p += np.bincount(held[good], minlength=WIDTH)
        q += np.bincount(held[~good], minlength=WIDTH)
        rows.extend(np.split(held.astype(np.int32), np.searchsorted(row, np.arange(1, len(part)))))
    ratio = np.log((p + smoothing) / (p + smoothing).sum()) - np.log((q + smoothing) / (q + smoothing).sum())
    ratio[p + q < 3] = 0  # an indicator of one or two texts says nothing about others
    norm = ratio**2
    # each example at length 1, with one more indicator for the intercept
    rows = [np.append(r[ratio[r] != 0], np.int32(WIDTH)) for r in rows]
    scaled = np.append(ratio, 0.0)
    own = []
    for r in rows:
        value = scaled[r]
        value /= max(np.sqrt((value**2).sum()), 1e-9)
        value[-1] = 1.0
        own.append(value.astype(np.float32))
    balance = np.where(y > 0, cost * len(y) / (2 * (y > 0).sum()), cost * len(y) / (2 * (y < 0).sum()))
    weights = dual_coordinate_descent(rows, own, y, balance, WIDTH + 1, rounds)
    margin = np.array([weights[r] @ v for r, v in zip(rows, own)])
    return Model((weights[:-1] * ratio).astype(np.float32), norm.astype(np.float32), float(weights[-1]), _steepness(margin, y))


def _steepness(margin: np.ndarray, y: np.ndarray) -> float:
    """Slope of a logistic curve through (0, 0.5) over the margin, by Newton steps; both classes weigh the same."""
    weight = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum())
    a = 1.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin, -30, 30)))
        g = (weight * (p - (y > 0)) * margin).sum() + 1e-3 * a
        a = min(max(a - g / ((weight * p * (1 - p) * margin**2).sum() + 1e-3), 0.1), 20.0)
    return float(a)


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", parts: int = 3, left_out: int = 1, rows: int = SAMPLE_ROWS,
    id_column: str = "doc_id", text_column: str = "text",
) -> Model:
    """Fit on labelled rows whose crc32(id as text) modulo `parts` is not `left_out`, at most `rows` of them."""
    sample = labelled_sample(docs, labels, label, parts, left_out, rows, id_column, text_column)
    found = sorted(sample.collect(), key=lambda r: (r["label_id"], r["text"]))[:rows]
    return fit([r["text"] for r in found], [r["label"] for r in found])


def score(
    docs: DataFrame, model: Model, threshold: float = 0.5, id_column: str = "doc_id", text_column: str = "text",
    keep: tuple[str, ...] = (), prefix: str = "",
) -> DataFrame:
    """(id, score, predicted) of every text, with the further columns named in `keep`; `prefix` goes before the new names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # WIDTH weights, whatever the corpus

    def run(batches):
        model = shared.value
        for batch in batches:
            texts = batch.column(0).to_pylist()
            chance = np.concatenate([model.score(part) for part in slices(texts, SCORE_CHARACTERS, TEXT_SHARE)]) if texts else np.zeros(0)
            new = [pa.array(chance), pa.array((chance >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *new], names=names)

    kept = [id_column, *keep]
    names = [*kept, f"{prefix}score", f"{prefix}predicted"]
    picked = docs.select(F.col(text_column).cast("string").alias(fresh(docs, "__scored_text")), *kept)
    kinds = [*docs.select(*kept).dtypes, (names[-2], "double"), (names[-1], "int")]
    schema = ", ".join(f"`{n}` {t}" for n, t in kinds)
    return picked.mapInArrow(giving_back(run), schema)

"""Hashed word features of many texts at once, and the bounded sample that a classifier is fitted on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from epigrid.llm.common import learned_rows

#: Characters of a sample's texts in all.
SAMPLE_CHARACTERS = 64_000_000
#: Odd multiplier of the polynomial hash, and its inverse modulo 2 ** 64.
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = np.random.default_rng(2024).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}
KEPT_POWERS = 1 << 21


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64; the longest table so far is kept, unless it is very long."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        factors = np.full(n, base, np.uint64)
        factors[0] = 1
        known = np.cumprod(factors)
        if n <= KEPT_POWERS:
            _powers[base] = known
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads a 64-bit hash over all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def buckets(h: np.ndarray, bits: int, salt: int = 0) -> np.ndarray:
    return (mix(h + np.uint64(salt * 0x2545F4914F6CDD1D % (1 << 64))) >> np.uint64(64 - bits)).astype(np.int64)


class Texts:
    """Bytes of some texts, each followed by a line feed, and where each byte belongs."""

    def __init__(self, texts: list[str | None]):
        raw = [(t or "").encode() for t in texts]
        self.count = len(raw)
        self.sizes = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
        self.data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes

    def doc_at(self, places: np.ndarray) -> np.ndarray:
        """Text that each byte place lies in."""
        return np.searchsorted(self.ends, places, side="right")

    def words(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each longest run of bytes that `inside` (by byte value) marks."""
        mark = np.zeros(len(self.data) + 2, np.int8)
        mark[1:-1] = inside[self.data]
        step = np.diff(mark)
        return np.flatnonzero(step == 1), np.flatnonzero(step == -1)

    def hashes(self, start: np.ndarray, end: np.ndarray, lower: bool = True) -> np.ndarray:
        """64-bit hash of the bytes from each start to before each end."""
        if not hasattr(self, "_sums"):
            data = _LOWER[self.data] if lower else self.data
            terms = _VALUE[data] * _power(_STEP, len(data))
            self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        back = _power(_BACK, len(self.data) + 1)
        return mix((self._sums[end] - self._sums[start]) * back[start])


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, parts: int, left_out: int, rows: int, id_column: str, text_column: str
) -> DataFrame:
    """At most `rows` texts with a label that may be learned, (label_id, text, label), picked by a hash of the id.

    Only `rows` ids are broadcast. Of an id that several rows repeat the text with the smallest hash counts. The texts, always whole,
    end before their characters go beyond SAMPLE_CHARACTERS in all; a first text that is longer by itself is left alone. Null ids, null texts and null labels take no part; a repeated label counts once, 1 wins.
    """
    allowed = (
        labels.where(learned_rows(id_column, parts, left_out) & F.col(label).isNotNull())
        .groupBy(F.col(id_column).alias("label_id"))
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(rows)
    )
    texts = docs.select(F.col(id_column).alias("label_id"), F.col(text_column).cast("string").alias("text"))
    found = texts.where(F.col("text").isNotNull()).join(F.broadcast(allowed), "label_id")
    once = found.groupBy("label_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("mark"), "text"))["text"].alias("text"))
    in_turn = Window.orderBy(F.xxhash64("label_id"), "label_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sized = once.withColumn("so_far", F.sum(F.char_length("text").cast("long")).over(in_turn)).withColumn("turn", F.count(F.lit(1)).over(in_turn))
    return sized.where((F.col("so_far") <= SAMPLE_CHARACTERS) | (F.col("turn") == 1)).select("label_id", "text", "label")

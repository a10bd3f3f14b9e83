"""Byte-pair merging of many words at once with numpy.

All words lie in one flat array of symbol numbers. A round looks up the rank of every neighbouring pair, takes the
smallest rank of each word (a segmented minimum), merges the leftmost pair of that rank in every word at once, and drops
the merged symbols and the finished words. Rounds go on until no pair is left. One merge per word and round gives the
order of the usual priority queue: lowest rank first, then leftmost.

A word of over `LONG` symbols would need as many rounds as it has symbols; it is merged with a heap, in the same order.
"""

from __future__ import annotations

import heapq

import numpy as np

LONG = 256
NONE = np.int64(1 << 40)


class Merges:
    """Pairs of symbols that merge: `left[i]`, `right[i]` become `merged[i]`, and the smaller `rank[i]` goes first."""

    def __init__(self, left, right, merged, rank):
        left, right = np.asarray(left, np.int64), np.asarray(right, np.int64)
        self.base = int(max(left.max(initial=0), right.max(initial=0))) + 1
        keys = left * self.base + right
        order = np.argsort(keys, kind="stable")
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.merged = np.append(np.asarray(merged, np.int64)[order], -1)
        self.rank = np.append(np.asarray(rank, np.int64)[order], NONE)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; rank NONE where it does not merge. Negative symbols never merge."""
        keys = left * self.base + right
        at = np.searchsorted(self.keys, keys)
        known = (self.keys[at] == keys) & (left >= 0) & (right >= 0) & (left < self.base) & (right < self.base)
        return np.where(known, self.rank[at], NONE), self.merged[at]

    def run(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge words that lie one after the other; lengths are at least 1. Symbols and lengths of the result."""
        lengths = np.asarray(lengths, np.int64)
        word = np.repeat(np.arange(len(lengths)), lengths)
        symbols = np.asarray(symbols, np.int64).copy()
        done_symbols, done_words = [], []
        if (lengths > LONG).any():
            ends = np.cumsum(lengths)
            for w in np.flatnonzero(lengths > LONG):
                out = self._heap(symbols[ends[w] - lengths[w] : ends[w]])
                done_symbols.append(out)
                done_words.append(np.full(len(out), w))
            short = (lengths <= LONG)[word]
            symbols, word = symbols[short], word[short]
        rank, merged = self._pairs(symbols, word)
        while len(symbols):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(word)))
            least_of = np.repeat(least, sizes)
            live = least_of < NONE
            if not live.all():
                done_symbols.append(symbols[~live])
                done_words.append(word[~live])
                symbols, word, rank, merged, least_of = (x[live] for x in (symbols, word, rank, merged, least_of))
                if not len(symbols):
                    break
            hits = np.flatnonzero(rank == least_of)
            hits = hits[np.diff(word[hits], prepend=-1) != 0]
            symbols[hits] = merged[hits]
            keep = np.ones(len(symbols), bool)
            keep[hits + 1] = False
            moved = hits - np.arange(len(hits))
            symbols, word, rank, merged = symbols[keep], word[keep], rank[keep], merged[keep]
            touched = np.zeros(len(symbols), bool)
            touched[moved] = touched[np.maximum(moved - 1, 0)] = True
            changed = np.flatnonzero(touched)
            rank[changed], merged[changed] = self._pairs_at(symbols, word, changed)
        if not done_symbols:
            return symbols, np.zeros(len(lengths), np.int64)
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return symbols[order], np.bincount(word, minlength=len(lengths))

    def _pairs(self, symbols, word):
        return self._pairs_at(symbols, word, np.arange(len(symbols)))

    def _pairs_at(self, symbols, word, at):
        after = np.minimum(at + 1, len(symbols) - 1)
        rank, merged = self.find(symbols[at], symbols[after])
        inside = (word[at] == word[after]) & (at < after)
        return np.where(inside, rank, NONE), merged

    def _heap(self, symbols: np.ndarray) -> np.ndarray:
        n = len(symbols)
        values, before, after = symbols.tolist(), list(range(-1, n - 1)), [*range(1, n), -1]
        rank, merged = self.find(symbols[:-1], symbols[1:])
        heap = [(int(r), i, values[i], values[i + 1], int(m)) for i, (r, m) in enumerate(zip(rank, merged)) if r < NONE]
        heapq.heapify(heap)

        def push(i: int) -> None:
            j = after[i]
            r, m = self.find(np.array([values[i]]), np.array([values[j]]))
            if r[0] < NONE:
                heapq.heappush(heap, (int(r[0]), i, values[i], values[j], int(m[0])))

        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            j = after[i]
            if values[i] != a or j < 0 or values[j] != b:
                continue
            values[i], values[j] = m, None
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
                push(i)
            if before[i] >= 0:
                push(before[i])
        return np.array([v for v in values if v is not None], np.int64)

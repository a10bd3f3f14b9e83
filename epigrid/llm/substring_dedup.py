"""Substring deduplication with suffix automata over shards of reference passages.

Every word that lies in a window of `window` words whose word sequence also starts anywhere else is removed; windows are
judged on the input. The work goes in four steps.

1. Each window gets an anchor: the smallest hash of the `GRAM`-word runs in it. Equal windows have equal anchors, so a window
   whose anchor occurs once in the corpus is unique. Only anchors and counts are shuffled for this.
2. Neighbouring windows with one repeated anchor form a segment. Segments are cut from the texts; equal ones become one.
3. The anchors deal the different segments into shards. A shard builds one suffix automaton over its segments, weighted by
   how often each occurs, and streams the segments through it: the matching statistic at a word is the state that holds
   the last `window` words, and its weight says how often the window occurs.
4. The marked windows go back to their documents by a join, and the words that they cover are removed.

The reference passages grow with the corpus, so the shards are not broadcast: each goes to the one task that streams the
segments which can match it. The number of shards follows the words in them, to keep an automaton small. An anchor with over
`CROWDED` different segments (a passage followed by ever new text) would not fit one automaton; its windows are counted one
by one by a 128-bit hash instead, with partial sums before the shuffle, so no window is skipped.

Null and empty texts have no words and keep none. A row is named by its id and its text's hash; rows that repeat both are
separate documents (their windows repeat) with the same result. Null ids are kept. Only the named columns are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

from epigrid.llm.common import fresh, giving_back, shards_for
from epigrid.llm.features import Texts, mix
from epigrid.session import cut_lineage

WINDOW = 35
GRAM = 8
SHARD_WORDS = 40_000
CROWDED = 4_000
SLICE = 1_000_000
_WORD = np.ones(256, bool)
_WORD[list(b" \t\n\x0b\x0c\r")] = False


class Automaton:
    """Suffix automaton of several word sequences with the weight of every state."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.weight = [-1], [0], [0]

    def _state(self, length: int, follow: dict, link: int) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        self.weight.append(0)
        return len(self.link) - 1

    def _split(self, p: int, c, q: int) -> int:
        """The state after p and c on its own, split from q, which also holds longer contexts."""
        clone = self._state(self.length[p] + 1, self.next[q].copy(), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def add(self, sequence: list, weight: int) -> None:
        last, follow, link, length = 0, self.next, self.link, self.length
        for c in sequence:
            q = follow[last].get(c)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, c, q)
            else:
                new, p = self._state(length[last] + 1, {}, 0), last
                while p >= 0 and c not in follow[p]:
                    follow[p][c] = new
                    p = link[p]
                if p >= 0:
                    q = follow[p][c]
                    link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
                last = new
            self.weight[last] += weight

    def finish(self) -> None:
        """Add every state's weight to those that hold its suffixes, longest first."""
        weight, link = self.weight, self.link
        for s in np.argsort(-np.array(self.length), kind="stable").tolist():
            if link[s] > 0:
                weight[link[s]] += weight[s]

    def repeated(self, sequence: list, window: int) -> list[int]:
        """Starts of the windows of a sequence that was added, which occur twice or more."""
        state, found = 0, []
        follow, link, length, weight = self.next, self.link, self.length, self.weight
        for i, c in enumerate(sequence):
            state = follow[state][c]
            while length[link[state]] >= window:
                state = link[state]
            if i >= window - 1 and weight[state] > 1:
                found.append(i - window + 1)
        return found


def _runs(starts: list[int]) -> list[tuple[int, int]]:
    """Runs of neighbouring numbers as (first, one past the last)."""
    if not starts:
        return []
    a = np.array(starts)
    cut = np.flatnonzero(np.diff(a) > 1) + 1
    return [(int(x[0]), int(x[-1]) + 1) for x in np.split(a, cut)]


def _slid(values: np.ndarray, width: int, least) -> np.ndarray:
    """`least` (a minimum or maximum) of every `width` neighbours; there are at least so many."""
    reach = 1
    while 2 * reach <= width:
        values = least(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return least(values[:-rest], values[rest:]) if rest else values


def _segments(texts: list[str | None], window: int):
    """Runs of windows with one anchor (text, first word from 0 in its text, number of windows, anchor), the places where an
    anchor stands (text, anchor), and the words."""
    block = Texts(texts)
    start, end = block.words(_WORD)
    doc = block.doc_at(start)
    first = np.searchsorted(doc, np.arange(block.count))
    n = len(start)
    empty = np.zeros(0, np.int64)
    if n < window:
        return block, start, end, first, (empty, empty), (empty, empty, empty, empty)
    word = block.hashes(start, end, lower=False)
    gram = word[: n - GRAM + 1].copy()
    for k in range(1, GRAM):
        gram = gram * np.uint64(0x9E3779B97F4A7C15) + word[k : n - GRAM + 1 + k]
    gram = mix(gram)
    width = window - GRAM + 1
    anchor = _slid(gram, width, np.minimum)
    whole = doc[: len(anchor)] == doc[window - 1 :]
    # a place is an anchor's if its hash is the largest of the smallest ones of the whole windows around it
    around = np.zeros(len(anchor) + 2 * (width - 1), np.uint64)
    around[width - 1 : len(around) - width + 1] = np.where(whole, anchor, 0)
    stands = np.flatnonzero((_slid(around, width, np.maximum) == gram) & (gram > 0))
    change = np.ones(len(anchor), bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | (doc[1 : len(anchor)] != doc[: len(anchor) - 1]) | ~whole[:-1]
    at = np.flatnonzero(change & whole)
    stop = np.flatnonzero(whole & np.append(change[1:] | ~whole[1:], True)) + 1
    owner = doc[at]
    places = doc[stands], gram[stands].view(np.int64)
    return block, start, end, first, places, (owner, at - first[owner], stop - at, anchor[at].view(np.int64))


def _sliced(texts: list[str | None]):
    """First row and texts of slices of about SLICE characters."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= SLICE or i == len(texts) - 1:
            yield begin, texts[begin : i + 1]
            begin, size = i + 1, 0


@F.udf(T.BinaryType(), useArrow=True)
def _squeezed(text):
    """A text as it goes through a shuffle: a third of the disk that Spark's own codec needs for it."""
    return zstandard.compress(text.encode())


def _named(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def _same_row(a: str, b: str) -> Column:
    return F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id")) & (F.col(f"{a}.mark") == F.col(f"{b}.mark"))


def _anchors(rows: DataFrame, window: int) -> DataFrame:
    """(id, mark, anchor, n): at how many places of a row each anchor stands."""

    def run(batches):
        for batch in batches:
            for begin, texts in _sliced(batch.column(2).to_pylist()):
                owner, anchor = _segments(texts, window)[4]
                order = np.lexsort((anchor, owner))
                owner, anchor = owner[order], anchor[order]
                fresh = np.ones(len(owner), bool)
                fresh[1:] = (owner[1:] != owner[:-1]) | (anchor[1:] != anchor[:-1])
                fresh = np.flatnonzero(fresh)
                n = np.diff(np.append(fresh, len(owner)))
                picked = pa.array(owner[fresh] + begin)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(picked), batch.column(1).take(picked), pa.array(anchor[fresh]), pa.array(n.astype(np.int64))],
                    names=["id", "mark", "anchor", "n"],
                )

    return rows.mapInArrow(giving_back(run), f"id {dict(rows.dtypes)['id']}, mark long, anchor long, n long")


def _cut(rows: DataFrame, window: int) -> DataFrame:
    """(id, mark, start, windows, anchor, segment): the segments of rows (id, mark, blob, anchors) that have one of the anchors."""

    def run(batches):
        for batch in batches:
            wanted = batch.column(3)
            for begin, texts in _sliced([zstandard.decompress(b).decode() for b in batch.column(2).to_pylist()]):
                block, start, end, first, _, (owner, at, size, anchor) = _segments(texts, window)
                part = wanted.slice(begin, len(texts))
                lists, values = part.offsets.to_numpy(), part.values.to_numpy()
                values, lists = values[lists[0] : lists[-1]], lists - lists[0]
                keep = _among(owner, anchor, np.repeat(np.arange(len(texts)), np.diff(lists)), values)
                owner, at, size, anchor = owner[keep], at[keep], size[keep], anchor[keep]
                a = first[owner] + at
                b = a + size + window - 2
                data = block.data.tobytes()
                cut = [b" ".join(data[x:y].split()) for x, y in zip(start[a].tolist(), end[b].tolist())]
                picked = pa.array(owner + begin)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(picked), batch.column(1).take(picked), pa.array(at), pa.array(size), pa.array(anchor), pa.array(cut, pa.binary()).cast(pa.string())],
                    names=["id", "mark", "start", "windows", "anchor", "segment"],
                )

    return rows.mapInArrow(giving_back(run), f"id {dict(rows.dtypes)['id']}, mark long, start long, windows long, anchor long, segment string")


def _among(owner, anchor, wanted_owner, wanted_anchor) -> np.ndarray:
    """Which (owner, anchor) pairs are wanted ones."""
    kinds, place = np.unique(np.concatenate([anchor, wanted_anchor]), return_inverse=True)
    key = np.concatenate([owner, wanted_owner]) * (len(kinds) + 1) + place
    return np.isin(key[: len(owner)], key[len(owner) :])


def _judge_shard(window: int):
    def judge(rows: pa.Table) -> pa.Table:
        numbers: dict[str, int] = {}
        number = numbers.setdefault
        sequences = [[number(w, len(numbers)) for w in s.split(" ")] for s in rows["segment"].to_pylist()]
        counts = rows["n"].to_pylist()
        automaton = Automaton()
        for s, n in zip(sequences, counts):
            automaton.add(s, n)
        automaton.finish()
        found = [_runs(automaton.repeated(s, window)) if n == 1 else [] for s, n in zip(sequences, counts)]
        return _marked(rows, found)

    return judge


def _marked(rows, found) -> pa.Table:
    some = np.array([bool(f) for f in found], bool)
    kept = [[{"a": a, "b": b} for a, b in f] for f in found if f]
    kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
    picked = rows.filter(pa.array(some))
    return pa.table({"anchor": picked["anchor"], "digest": picked["digest"], "runs": pa.array(kept, kind)})


_MARKS = "anchor long, digest long, runs array<struct<a: bigint, b: bigint>>"


def _crowded_windows(rows: DataFrame, window: int) -> DataFrame:
    """(anchor, digest, at, hash, n): the windows of the segments of crowded anchors."""

    def run(batches):
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for i, s in enumerate(batch.column(2).to_pylist()):
                words = s.encode().split(b" ")
                hashes = [digest(b" ".join(words[k : k + window])) for k in range(len(words) - window + 1)]
                picked = pa.array(np.full(len(hashes), i))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(picked), batch.column(1).take(picked), pa.array(np.arange(len(hashes))), pa.array(hashes, pa.binary()), batch.column(3).take(picked)],
                    names=["anchor", "digest", "at", "hash", "n"],
                )

    return rows.select("anchor", "digest", "segment", "n").mapInArrow(giving_back(run), "anchor long, digest long, at long, hash binary, n long")


def repeated_ranges(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """(id, mark, ranges): the word ranges [a, b) of each row (id, mark, text) that repeated windows cover."""
    spread = _anchors(rows, window)
    often = spread.groupBy("anchor").agg(F.sum("n").alias("total")).where("total > 1").select("anchor")
    wanted = spread.join(often, "anchor").groupBy("id", "mark").agg(F.collect_set("anchor").alias("anchors"))
    squeezed = rows.select("id", "mark", _squeezed("text").alias("blob")).alias("r")
    joined = squeezed.join(wanted.alias("w"), _same_row("r", "w")).select("r.id", "r.mark", "r.blob", "w.anchors")
    cut = cut_lineage(_cut(joined, window).withColumn("digest", F.xxhash64("segment")), "segments")
    counted = cut.groupBy("anchor", "digest").agg(F.count(F.lit(1)).alias("n"))
    counted = cut_lineage(counted, "segment-counts")
    # a segment that stands twice is repeated throughout; its text matters only if its anchor has other segments
    kinds = counted.groupBy("anchor").agg(F.count(F.lit(1)).alias("segments"), F.min("n").alias("least"))
    unsure = kinds.where("least = 1")
    again = counted.where("n > 1").select("anchor", "digest", F.array(F.struct(F.lit(0).cast("long").alias("a"), F.lit(None).cast("long").alias("b"))).alias("runs"))
    # equal segments are counted before the shuffle and spread by their text, so a common passage is no hot key
    different = cut.groupBy("anchor", "digest", "segment").agg(F.count(F.lit(1)).alias("n")).join(unsure, "anchor")
    words = counted.join(unsure, "anchor").agg(F.count(F.lit(1))).first()[0] * 2 * window
    shards = shards_for(words, SHARD_WORDS)
    plain = different.where(F.col("segments") <= CROWDED).drop("segments")
    dealt = plain.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    marks = dealt.groupBy("shard").applyInArrow(_judge_shard(window), _MARKS)
    single = _crowded_windows(different.where(F.col("segments") > CROWDED), window)
    twice = single.groupBy("anchor", "hash").agg(F.sum("n").alias("times")).where("times > 1").select("anchor", "hash")
    runs = single.join(twice, ["anchor", "hash"]).select(
        "anchor", "digest", F.array(F.struct(F.col("at").alias("a"), (F.col("at") + 1).alias("b"))).alias("runs")
    )
    places = cut.select("id", "mark", "start", "windows", "anchor", "digest")
    placed = places.join(again.unionAll(marks).unionAll(runs), ["anchor", "digest"])
    covered = F.transform(
        "runs",
        lambda r: F.struct(
            (F.col("start") + r["a"]).alias("a"), (F.col("start") + F.coalesce(r["b"], F.col("windows")) + window - 1).alias("b")
        ),
    )
    return placed.groupBy("id", "mark").agg(F.flatten(F.collect_set(covered)).alias("ranges"))


def _removed(words: int, ranges: list[dict] | None) -> np.ndarray:
    step = np.zeros(words + 1, np.int64)
    if ranges:
        np.add.at(step, [r["a"] for r in ranges], 1)
        np.add.at(step, [r["b"] for r in ranges], -1)
    return np.cumsum(step[:-1]) > 0


def _with_ranges(docs: DataFrame, window: int, id_column: str, text_column: str) -> tuple[DataFrame, str, str, str]:
    """The rows without the text, and the names of three columns more: the squeezed text, whether the text is null, and what
    repeated windows cover or null."""
    ranges = repeated_ranges(_named(docs, id_column, text_column), window).alias("c")
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    mark, null, blob, covered = (fresh(docs, n) for n in ("__mark", "__null", "__blob", "__ranges"))
    rows = docs.withColumns({mark: F.xxhash64(text), null: F.col(text_column).isNull(), blob: _squeezed(text)})
    same = F.col(f"d.{id_column}").eqNullSafe(F.col("c.id")) & (F.col(f"d.{mark}") == F.col("c.mark"))
    joined = rows.drop(text_column).alias("d").join(ranges, same, "left")
    return joined.select("d.*", F.col("c.ranges").alias(covered)), blob, null, covered


def digests(docs: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: n_words, n_removed, and the SHA-256 of the kept words joined by one space."""

    def run(batches):
        for batch in batches:
            n, gone, sha = [], [], []
            for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = zstandard.decompress(text).split()
                removed = _removed(len(words), ranges)
                kept = [w for w, r in zip(words, removed.tolist()) if not r] if ranges else words
                n.append(len(words))
                gone.append(len(words) - len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [id_column, "n_words", "n_removed", "kept_sha256"]
    rows, blob, _, covered = _with_ranges(docs.select(id_column, text_column), window, id_column, text_column)
    rows = rows.select(id_column, blob, covered)
    kind = dict(rows.dtypes)[id_column]
    return rows.mapInArrow(run, f"`{id_column}` {kind}, n_words long, n_removed long, kept_sha256 string")


def clean(docs: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows with their repeated passages cut out of the text; a text without any stays byte for byte."""

    @F.udf(T.StringType(), useArrow=True)
    def without(blob, ranges):
        text = zstandard.decompress(blob)
        if ranges:
            words = text.split()
            text = b" ".join(w for w, r in zip(words, _removed(len(words), ranges).tolist()) if not r)
        return text.decode()

    rows, blob, null, covered = _with_ranges(docs, window, id_column, text_column)
    cleaned = F.when(~F.col(null), without(blob, covered))
    return rows.withColumn(text_column, cleaned).select(*docs.columns)

"""SimHash near-duplicates through Golay-code fuzzy hashing.

A fingerprint has 64 bits, three segments of 22, 21 and 21. Two fingerprints link if at most four bits differ, so either
some segment has no error, or all have one or two and two of them exactly one.

- Some segment equal: at most four errors lie in the other bits; cut into five parts, one of them is equal too. The key is
  the segment and the part.
- Two segments with one error each: a segment, padded to 23 bits, is decoded by the perfect binary Golay code, which maps
  every word to the one codeword within three bits. All words one bit away from a word decode to at most six codewords,
  so one side looks up the pair of its own codewords and the other side offers up to 6 x 6 pairs.

Candidates are verified on the fingerprints inside the join, and only under the first key that they must share, so each link
leaves the join once. Equal fingerprints are one node before that, whatever their number; there is no cap on buckets.

Null and empty texts have fingerprint zero and are linked like any other. Null ids are kept and never become a component's id
unless it has no other. Repeated rows belong to the same component. Only the named columns are read; an empty table gives no rows.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from epigrid.llm.common import fresh, giving_back, shards_for
from epigrid.llm.components import connected_components
from epigrid.session import cut_lineage

DISTANCE = 4
SEED = 42
SEGMENTS = ((0, 22), (22, 43), (43, 64))
PAIRS = ((0, 1), (0, 2), (1, 2))
PARTS = DISTANCE + 1
#: Fingerprints whose keys one task makes.
PER_TASK = 20_000
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_TRIPLE = 0b101011100011  # generator polynomial of the Golay code, degree 11


def _mask(bits) -> int:
    return sum(1 << b for b in bits)


SEGMENT_MASKS = tuple(_mask(range(a, b)) for a, b in SEGMENTS)


def _part_masks(segment: int) -> list[int]:
    a, b = SEGMENTS[segment]
    rest = [x for x in range(64) if not a <= x < b]
    return [_mask(x.tolist()) for x in np.array_split(np.array(rest), PARTS)]


def word_shingles(text: str | None, width: int) -> list[bytes]:
    words = (text or "").encode().translate(_FOLD).split()
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    return [line[a:b] for a, b in zip(starts[: 1 - width].tolist(), (ends[width - 1 :] - 1).tolist())]


def fingerprint(text: str | None, width: int = 4) -> int:
    """Bit k is set if it is set in over half of the hashes of the word shingles."""
    shingles = word_shingles(text, width)
    if not shingles:
        return 0
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], "<u8").view(np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        counts += np.unpackbits(hashes[at : at + 65536], axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 4, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, bits): the fingerprint of every row as a signed long."""

    def run(batches):
        for batch in batches:
            bits = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits)], names=[id_column, "bits"])

    picked = docs.select(F.col(id_column), F.col(text_column).cast("string"))
    return picked.mapInArrow(giving_back(run), f"`{id_column}` {dict(picked.dtypes)[id_column]}, bits long")


@lru_cache(maxsize=1)
def decoder() -> np.ndarray:
    """Number of the codeword within three bits of every 23-bit word."""
    codewords = np.zeros(1, np.uint32)
    for k in range(12):
        codewords = np.concatenate([codewords, codewords ^ np.uint32(_TRIPLE << k)])
    errors = np.array([_mask(c) for n in range(4) for c in combinations(range(23), n)], np.uint32)
    table = np.empty(1 << 23, np.uint16)
    for number, word in enumerate(codewords.tolist()):
        table[errors ^ np.uint32(word)] = number
    return table


def _segments(bits: np.ndarray) -> list[np.ndarray]:
    return [((bits >> np.uint64(a)) & np.uint64((1 << b - a) - 1)).astype(np.uint32) for a, b in SEGMENTS]


def _near_codewords(segment: np.ndarray) -> list[np.ndarray]:
    """Per word the different codewords of itself and of all words one bit away."""
    flips = np.array([0, *(1 << k for k in range(23))], np.uint32)
    found = np.sort(decoder()[segment[:, None] ^ flips], axis=1)
    fresh = np.concatenate([np.ones((len(found), 1), bool), found[:, 1:] != found[:, :-1]], axis=1)
    return np.split(found[fresh], np.cumsum(fresh.sum(1))[:-1])


def _equal_keys(bits: np.ndarray):
    for s in range(3):
        for p, mask in enumerate(_part_masks(s)):
            yield len(PAIRS) + s * PARTS + p, bits & np.uint64(mask | SEGMENT_MASKS[s]), np.arange(len(bits))


def _own_keys(bits: np.ndarray):
    """Kind of key, key, and row: what a fingerprint is looked up by."""
    code = [decoder()[s].astype(np.uint64) for s in _segments(bits)]
    for kind, (i, j) in enumerate(PAIRS):
        yield kind, code[i] << np.uint64(12) | code[j], np.arange(len(bits))
    yield from _equal_keys(bits)


def _offered_keys(bits: np.ndarray):
    near = [_near_codewords(s) for s in _segments(bits)]
    for kind, (i, j) in enumerate(PAIRS):
        keys = [(x.astype(np.uint64)[:, None] << np.uint64(12) | y.astype(np.uint64)).ravel() for x, y in zip(near[i], near[j])]
        yield kind, np.concatenate(keys), np.repeat(np.arange(len(bits)), [len(k) for k in keys])
    yield from _equal_keys(bits)


def _keyed(nodes: DataFrame, make) -> DataFrame:
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            bits = batch.column(0).to_numpy().view(np.uint64)
            for kind, key, row in make(bits):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), kind, np.int32)), pa.array(key.view(np.int64)), pa.array(bits[row].view(np.int64))],
                    names=["kind", "key", "bits"],
                )

    return nodes.select("bits").mapInArrow(run, "kind int, key long, bits long")


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def _first_kind(x: Column) -> Column:
    """Kind of the first key that two fingerprints with difference x must share."""
    errors = [F.bit_count(x.bitwiseAND(_signed(m))) for m in SEGMENT_MASKS]
    kind = F.lit(None).cast("int")
    for k, (i, j) in reversed([*enumerate(PAIRS)]):
        kind = F.when((errors[i] == 1) & (errors[j] == 1), F.lit(k)).otherwise(kind)
    for s in (2, 1, 0):
        equal = F.lit(None).cast("int")
        for p, mask in reversed([*enumerate(_part_masks(s))]):
            equal = F.when(x.bitwiseAND(_signed(mask)) == 0, F.lit(len(PAIRS) + s * PARTS + p)).otherwise(equal)
        kind = F.when(errors[s] == 0, equal).otherwise(kind)
    return kind


def links(nodes: DataFrame) -> DataFrame:
    """(a, b) for all different fingerprints of `nodes.bits` with at most four differing bits, a < b, each once."""
    own, offered = _keyed(nodes, _own_keys).alias("o"), _keyed(nodes, _offered_keys).alias("f")
    x = F.col("o.bits").bitwiseXOR(F.col("f.bits"))
    condition = (
        (F.col("o.kind") == F.col("f.kind")) & (F.col("o.key") == F.col("f.key")) & (F.col("o.bits") < F.col("f.bits"))
        & (F.bit_count(x) <= DISTANCE) & (F.col("o.kind") == _first_kind(x))
    )
    return own.join(offered.hint("merge"), condition).select(F.col("o.bits").alias("a"), F.col("f.bits").alias("b"))


def near_duplicates(
    docs: DataFrame, width: int = 4, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, fingerprint as 16 hex digits, component_id) of every row; the component's smallest id names it."""
    marked = cut_lineage(fingerprints(docs, width, id_column, text_column), "fingerprints")
    nodes = marked.groupBy("bits").agg(F.min(id_column).alias("least"))
    nodes = cut_lineage(nodes, "fingerprint-nodes")
    dealt = nodes.repartition(shards_for(nodes.count(), PER_TASK), "bits")  # a fingerprint becomes about a hundred keys
    member = connected_components(links(dealt)).withColumnRenamed("node", "bits")
    rooted = nodes.join(member, "bits", "left").withColumn("root", F.coalesce("root", "bits"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_bits = rooted.join(named, "root").select("bits", "component_id")
    digits = F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint")
    return marked.join(of_bits, "bits").select(id_column, digits, "component_id")


def representatives(docs: DataFrame, width: int = 4, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows, one of each component: that with the smallest id, a null id last. Rows that repeat id and text leave one."""
    text, row = F.coalesce(F.col(text_column).cast("string"), F.lit("")), fresh(docs, "__row")
    marked = docs.withColumn(row, F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"), F.xxhash64(text).alias("mark")))
    found = near_duplicates(marked, width, row, text_column).where(F.col("component_id").eqNullSafe(F.col(row)))
    names = found.select(row).distinct().alias("s")
    rows = marked.alias("d").join(names, F.col(f"d.{row}").eqNullSafe(F.col(f"s.{row}")), "left_semi")
    return rows.dropDuplicates([row]).drop(row)

"""Best-fit packing of documents into sequences by the sum-of-squares rule.

Texts become ids, a separator follows each document, and only documents longer than a sequence are cut. Pieces are dealt
evenly into shards by a hash, longest first inside a shard. Each piece goes where the sum over residual gaps of (open
sequences with that gap) squared becomes smallest; a new sequence is opened only when the piece fits in none. The rule needs
only the counts per gap, so a shard holds the places of its own pieces and nothing else. The number of shards follows the
number of documents; a shard leaves a few sequences part empty, whatever the size of the table.

Null texts count as empty (the separator alone), null ids are kept, repeated rows are packed each for itself, equal lengths
go by document and piece, an empty table gives no rows, and further columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from epigrid.llm.common import giving_back, shards_for, slices
from epigrid.llm.word_bpe import CACHED, word_bpe

SEPARATOR = (0).to_bytes(4, "little")
PER_SHARD = 50_000


def pieces(
    docs: DataFrame, tokenizer: str, length: int, id_column: str = "doc_id", text_column: str = "text", ids: bool = False,
    added_tokens: bool = False, remember: int = CACHED,
) -> DataFrame:
    """Pieces of every document: (id, piece, start, length, ids_crc32), and the ids themselves if asked for.

    Strings of the file's added tokens are ordinary text, or with `added_tokens` those tokens, as the library has it by default.
    `remember` bounds the units and words that a worker keeps between batches.
    """

    def run(batches):
        bpe, width = word_bpe(tokenizer, added_tokens, remember), 4 * length
        for batch in batches:
            row, piece, start, size, crc, raw = [], [], [], [], [], []
            coded = (data for part in slices(batch.column(1).to_pylist()) for data in bpe.encode(part))
            for i, data in enumerate(coded):
                data += SEPARATOR
                for k, at in enumerate(range(0, len(data), width)):
                    part = data[at : at + width]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    size.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if ids:
                        raw.append(np.frombuffer(part, "<u4").astype(np.int32))
            columns = [
                batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(size, pa.int64()), pa.array(crc, pa.int64()),
            ]
            if ids:
                columns.append(pa.array(raw, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [id_column, "piece", "start", "length", "ids_crc32"] + ["ids"] * ids
    picked = docs.select(F.col(id_column), F.col(text_column).cast("string"))
    kind = dict(picked.dtypes)[id_column]
    schema = f"`{id_column}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * ids
    # a worker that is to remember much keeps it
    return picked.mapInArrow(run if remember >= CACHED else giving_back(run), schema)


def places(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length, in the order given."""
    open_at = [[] for _ in range(capacity + 1)]  # sequences by residual gap
    count = np.zeros(capacity + 1, np.int64)
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened = 0
    for i, size in enumerate(lengths.tolist()):
        gaps = np.flatnonzero(count[size:capacity])
        if len(gaps):
            gaps += size
            growth = 2 * (count[gaps - size] - count[gaps]) + 2  # of the sum of squares
            if gaps[0] == size:  # a full sequence counts no more
                growth[0] = 1 - 2 * count[size]
            gap = int(gaps[growth.argmin()])
            count[gap] -= 1
            sequence[i] = open_at[gap].pop()
        else:
            gap = capacity
            sequence[i] = opened
            opened += 1
        offset[i] = capacity - gap
        rest = gap - size
        if rest:
            count[rest] += 1
            open_at[rest].append(int(sequence[i]))
    return sequence, offset


def pack(
    docs: DataFrame, tokenizer: str, length: int = 2048, id_column: str = "doc_id", text_column: str = "text",
    per_shard: int = PER_SHARD, added_tokens: bool = False, remember: int = CACHED,
) -> DataFrame:
    """Place of every piece: the columns of `pieces`, sequence_id and offset."""
    cut = pieces(docs, tokenizer, length, id_column, text_column, added_tokens=added_tokens, remember=remember)
    shards = shards_for(docs.count(), per_shard)

    def place(rows: pa.Table) -> pa.Table:
        shard = rows["shard"][0].as_py()
        rows = rows.drop_columns("shard").sort_by(
            [("length", "descending"), (id_column, "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]
        )
        sequence, offset = places(rows["length"].to_numpy(), length)
        return rows.append_column("sequence_id", pa.array(sequence * shards + shard)).append_column("offset", pa.array(offset))

    dealt = cut.withColumn("shard", F.pmod(F.xxhash64(id_column, "piece", "ids_crc32"), F.lit(shards)))
    schema = ", ".join(f"`{n}` {t}" for n, t in [*cut.dtypes, ("sequence_id", "bigint"), ("offset", "bigint")])
    return dealt.groupBy("shard").applyInArrow(place, schema)


def sequences(
    docs: DataFrame, placed: DataFrame, tokenizer: str, length: int = 2048, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Packed sequences: (sequence_id, ids, parts), parts listing the documents' pieces in order. A sequence is bounded by
    `length`, so no group can grow. Rows that repeat a document with other text are told apart by their checksum."""
    filled = pieces(docs, tokenizer, length, id_column, text_column, ids=True).dropDuplicates([id_column, "piece", "ids_crc32"])
    key = [id_column, "piece", "ids_crc32"]
    p, f = placed.alias("p"), filled.alias("f")
    same = F.col(f"p.{id_column}").eqNullSafe(F.col(f"f.{id_column}"))
    for name in key[1:]:
        same &= F.col(f"p.{name}") == F.col(f"f.{name}")
    part = F.struct("p.offset", f"p.{id_column}", "p.piece", "p.start", "p.length", "f.ids")
    joined = p.join(f, same).groupBy("p.sequence_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    return joined.select(
        "sequence_id",
        F.flatten(F.col("parts.ids")).alias("ids"),
        F.transform("parts", lambda x: x.dropFields("ids")).alias("parts"),
    )

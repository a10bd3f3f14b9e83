"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: ASCII white space: a word is a longest run of other characters.
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """`name`, or with underscores after it a name that no column of the table has, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row, however often the body or a lambda inside it names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Array of the words of a text; null has none."""
    plain = F.translate(F.coalesce(text, F.lit("")), WHITE[1:], " " * (len(WHITE) - 1))
    return F.array_remove(F.split(plain, " "), "")


def learned_rows(id_column: str, parts: int, left_out: int) -> Column:
    """True for the rows whose labels may be learned: crc32 of the id as text, modulo `parts`, is not `left_out`."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % parts != left_out, F.lit(False))


def shards_for(rows: int, per_shard: int) -> int:
    return max(1, -(-rows // per_shard))


def slices(texts: list[str | None], characters: int = 2_000_000, each: int = 0) -> Iterator[list[str | None]]:
    """The texts in turn, in lists of about so many characters, so that what is made of them stays small.

    Every text counts `each` characters besides its own, which bounds the number of texts too.
    """
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t or "") + each
        if size >= characters:
            yield part
            part, size = [], 0
    if part:
        yield part


def giving_back(run: Callable) -> Callable:
    """The same function over Arrow batches, after whose last batch the worker gives freed memory back to the system.

    Workers are used again by later stages; without this each keeps what its largest task needed.
    """

    def wrapped(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        libc = ctypes.CDLL(None)
        if hasattr(libc, "malloc_trim"):  # glibc
            libc.malloc_trim(0)

    return wrapped

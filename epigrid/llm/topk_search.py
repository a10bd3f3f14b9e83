"""Exact top-k search by no-random-access aggregation.

Every vector component is quantised to an integer; the score of a row for a query is their inner product. The rows are dealt
into blocks, the queries into blocks, and each pair of blocks is one unit of work: a stated query set against all rows. Both
blocks are as large as a task holds with ease, since a row moves once per query block and a query once per row block. Within
a unit there is one list per component, sorted by value; a query with a positive weight reads it from the top, one with a
negative weight from the bottom. The lists are read in step, some entries at a time, for all queries of the unit. Per row and
query the sum over the entries read, with the end of the list standing in for each entry not read, bounds the score from below;
the last value read in its place bounds it from above. The reading stops for a query when few rows can still reach its k-th
lower bound; outsiders can't qualify any more, and those few get their final scores in integers. The k best of each unit are
merged per query.

Bounds are kept in single precision, widened by what its rounding can lose. A vector whose quantised components reach 2 ** 28, or whose
length reaches 2 ** 31, is set apart: its scores are bounded in extended precision and resolved in Python's integers. The ranks are
exact in any case; a score that fits no long is null.

Null vectors, vectors with a null or non-finite component and empty vectors take no part. A query meets only rows of its own
width. Rows without an id take no part. A query's own row is left out by id; an id
that several rows repeat is one query, asked with the smallest of its vectors, and its rows are candidates for other queries
each for itself. Ties go to the smaller id. Only the named columns are read; an empty table gives no rows.
"""

from __future__ import annotations

import math
from operator import mul

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from epigrid.llm.common import shards_for

ROWS_PER_BLOCK = 16384
QUERIES_PER_BLOCK = 32768
QUERIES_AT_ONCE = 128
LIMIT = 1 << 28
#: Part of each list read before the first look at the bounds, and what it grows by.
FIRST_DEPTH, STEP_DEPTH = 0.35, 0.10
#: A query is resolved when at most this part of a block's rows can still qualify.
FEW = 1 / 16
#: How the order of scores beyond a long is spelled: text that sorts as the scores do, with this mark for all that fit.
FITS = "5"
_COMPLEMENT = str.maketrans("0123456789", "9876543210")


def quantised(embeddings: DataFrame, scale: int = 256, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, vector array<int>, large array<double>, width) of the vectors that take part: floor(scale * x) of every component, or for
    a vector that is too large for that the components themselves."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf"))

    vector = F.col(vector_column)
    taken = F.coalesce(F.col(id_column).isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite), F.lit(False))
    given = embeddings.where(taken).select(
        F.col(id_column).cast("long").alias("id"), F.transform(vector, lambda x: x.cast("double")).alias("x")
    )
    length = F.aggregate("x", F.lit(0.0), lambda s, x: s + (F.abs(x) + 1) * (F.abs(x) + 1)) * float(scale * scale)
    small = F.forall("x", lambda x: F.abs(x) < (LIMIT - 1) / scale) & (length < float(1 << 62))
    whole = F.transform("x", lambda x: F.floor(x * scale).cast("int"))
    return given.select("id", F.when(small, whole).alias("vector"), F.when(~small, F.col("x")).alias("large"), F.size("x").alias("width"))


class Lists:
    """The sorted lists of a block of rows."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.order = np.argsort(rows, axis=0, kind="stable").astype(np.int32)  # per component, rows from the smallest value up
        self.sorted = np.take_along_axis(rows, self.order, axis=0).astype(np.float32)
        self.most = np.abs(rows).max(axis=0).astype(float)

    def top(self, queries: np.ndarray, barred: np.ndarray, k: int) -> list[np.ndarray]:
        """Rows that hold the k best of each query, and maybe some more; barred[q] is the row that q may not have or -1."""
        n, width = self.rows.shape
        lowest, highest = self.sorted[0], self.sorted[-1]
        # the two halves of a matrix: lists read from the top and lists read from the bottom
        weights = np.hstack([np.maximum(queries, 0), np.minimum(queries, 0)]).astype(np.float32)
        least = np.empty((n, 2 * width), np.float32)  # what an entry adds at least: its value once read, before that the list's end
        least[:, :width], least[:, width:] = lowest, highest
        unread = np.ones((n, 2 * width), np.float32)
        slack = ((2 * width + 8) * 2.0**-22 * (np.abs(queries) @ self.most)).astype(np.float32)[:, None]
        column = np.arange(width)
        out: list[np.ndarray | None] = [None] * len(queries)
        live, done, depth = np.arange(len(queries)), 0, max(1, int(FIRST_DEPTH * n))
        while len(live):
            at = self.order[done:depth], column + width
            least[at], unread[at] = self.sorted[done:depth], 0
            at = self.order[n - depth : n - done], column
            least[at], unread[at] = self.sorted[n - depth : n - done], 0
            last = depth >= n
            w = weights[live]
            lower = w @ least.T
            spread = np.concatenate([self.sorted[n - depth] - lowest, self.sorted[depth - 1] - highest])
            upper = lower + slack[live] if last else lower + slack[live] + (w * spread) @ unread.T
            lower -= slack[live]
            own = np.flatnonzero(barred[live] >= 0)
            lower[own, barred[live][own]] = upper[own, barred[live][own]] = -np.inf
            kth = np.partition(lower, n - k, axis=1)[:, n - k] if n >= k else np.full(len(live), -np.inf)
            possible = (upper >= kth[:, None]) & (upper > -np.inf)
            ready = (possible.sum(axis=1) <= max(8 * k, FEW * n)) | last
            for q in np.flatnonzero(ready):
                out[live[q]] = np.flatnonzero(possible[q])
            live, done = live[~ready], depth
            depth = min(n, depth + max(1, int(STEP_DEPTH * n)))
        return out


def integers(vector: np.ndarray, scale: int = 256) -> list[int]:
    """floor(scale * x) in Python's integers; x beyond 2 ** 900 is whole, and its product may leave the doubles."""
    return [math.floor(x * scale) if abs(x) < 2.0**900 else int(x) * scale for x in vector.tolist()]


def spelled(score: int) -> tuple[int, str]:
    """The nearest long, and text that orders the scores that share it."""
    if -(1 << 63) <= score < 1 << 63:
        return score, FITS
    digits = str(abs(score))
    if score > 0:
        return (1 << 63) - 1, f"9{len(digits):04}{digits}"
    return -(1 << 63), f"1{9999 - len(digits):04}{digits.translate(_COMPLEMENT)}"


def apart(rows: np.ndarray, ids: np.ndarray, query: np.ndarray, query_id: int, k: int) -> list[tuple[int, int, str]]:
    """The k best rows of one query, of components of any size: bounds in extended precision, then integers."""
    held = np.flatnonzero(ids != query_id)
    if not len(held):
        return []
    with np.errstate(all="ignore"):  # where extended precision is none, a bound that is no number bars nothing
        wide, asked = (np.floor(x.astype(np.longdouble) * 256) for x in (rows[held], query))
        about = wide @ asked
        slack = (len(asked) + 4) * 2 * np.finfo(np.longdouble).eps * (np.abs(wide) @ np.abs(asked))
        lower = np.nan_to_num(about - slack, nan=-np.inf, posinf=-np.inf, neginf=-np.inf)
        upper = np.nan_to_num(about + slack, nan=np.inf, posinf=np.inf, neginf=np.inf)
    kth = np.sort(lower)[-k] if len(held) >= k else -np.inf
    whole = integers(query)
    scored = [(-sum(map(mul, integers(rows[i]), whole)), int(ids[i])) for i in held[upper >= kth]]
    return [(i, *spelled(-s)) for s, i in sorted(scored)[:k]]


def _matrix(t: pa.Table, column: str, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of the rows that have one in this column, in the order of the ids."""
    t = t.filter(pc.is_valid(t[column]))
    ids, flat = t["id"].to_numpy(), t[column].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    order = np.argsort(ids, kind="stable")
    return ids[order], flat.reshape(len(ids), -1 if len(ids) else 0)[order].astype(kind)


def _unit(k: int):
    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        beyond: list[tuple[int, int, int, str]] = []
        (ids, vectors), (asked, questions) = _matrix(rows, "vector", np.int64), _matrix(queries, "vector", np.int64)
        if len(ids) and len(asked):
            lists = Lists(vectors)
            for begin in range(0, len(asked), QUERIES_AT_ONCE):
                part = slice(begin, begin + QUERIES_AT_ONCE)
                first, last = np.searchsorted(ids, asked[part]), np.searchsorted(ids, asked[part], side="right")
                barred = np.where(last > first, first, -1)
                extra = int((last - first).max(initial=0))  # rows that repeat a query's id are dropped below
                for q, near in enumerate(lists.top(questions[part], barred, k + max(0, extra - 1))):
                    near = near[ids[near] != asked[begin + q]]
                    score = vectors[near] @ questions[begin + q]
                    best = np.lexsort((ids[near], -score))[:k]
                    found.append((np.full(len(best), asked[begin + q]), ids[near][best], score[best]))
        (large_ids, large), (large_asked, large_questions) = _matrix(rows, "large", float), _matrix(queries, "large", float)
        if len(large_ids):
            for i, q in zip(asked, questions):
                beyond += [(int(i), *hit) for hit in apart(large, large_ids, q / 256, i, k)]
        if len(large_asked):
            blocks = [(ids, vectors / 256)] * bool(len(ids)) + [(large_ids, large)] * bool(len(large_ids))
            for i, q in zip(large_asked, large_questions):
                for its, block in blocks:
                    beyond += [(int(i), *hit) for hit in apart(block, its, q, i, k)]
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 3
        plain = pa.table([*map(pa.array, columns), pa.array([FITS] * len(columns[0]), pa.string())], schema=_FOUND)
        return pa.concat_tables([plain, pa.table([pa.array(c, f.type) for c, f in zip(zip(*beyond) if beyond else [()] * 4, _FOUND)], schema=_FOUND)])

    return search


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("beyond", pa.string())])


def nearest(embeddings: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of every row for which `is_query`, a condition on `id`, holds."""
    rows = quantised(embeddings, id_column=id_column, vector_column=vector_column)
    queries = rows.where(is_query).groupBy("id", "width").agg(F.min(F.struct(F.col("vector").isNull(), "vector", "large")).alias("v"))
    queries = queries.select("id", "v.vector", "v.large", "width")
    total = embeddings.count()
    row_blocks, query_blocks = shards_for(total, ROWS_PER_BLOCK), shards_for(queries.count(), QUERIES_PER_BLOCK)
    # each row goes to all query blocks, each query to all row blocks; a unit is one of each
    blocked = rows.withColumn("r", F.pmod(F.xxhash64("id", "vector", "large"), F.lit(row_blocks)).cast("int"))
    blocked = blocked.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    asked = queries.withColumn("q", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int"))
    asked = asked.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
    unit = ["r", "q", "width"]
    found = blocked.groupBy(*unit).cogroup(asked.groupBy(*unit)).applyInArrow(_unit(k), "query_id long, vec_id long, score long, beyond string")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", F.when(F.col("beyond") == FITS, F.col("score")).alias("score"))

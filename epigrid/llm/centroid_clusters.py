"""Centroid clustering in integers, with a PCA-rotated filter in front of the exact distances.

Every vector component is quantised to an integer. All vectors are rotated onto the principal axes of the whole table; of the
rotated form only the leading coordinates and the norm of the rest are stored. For a vector and a centroid the squared distance of
the leading coordinates plus the squared difference of the two rest norms can't exceed their squared distance. The nearest centroid
by that bound is measured in integers; only centroids whose bound is not above that distance are measured too, and the integers
decide. A rotation that fits badly costs time, never a wrong row: the bound holds for every rotation.

A round reads the stored vectors once. A task adds its vectors up per cluster before the shuffle, so a round moves and returns no
more than clusters x components sums, whatever the table and however many vectors fall into one cluster.

Vectors that are null, have another width than `width`, or hold a null or non-finite component take no part. Components beyond
2 ** 26 once quantised are counted by Python integers, in limbs of 24 bits where sums leave a task; a squared distance that does not
fit a long is null, as is a sum that holds one or does not fit; the assignment is exact even so. Rows with a null id are clustered but
start no centroid. Repeated rows count each for itself; if rows with one id could start several centroids, they come in the order of
their vectors. Fewer vectors than `k` start as many centroids as there are; an empty table gives no rows. Only the named columns are
read.
"""

from __future__ import annotations

import hashlib
import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from epigrid.session import cut_lineage

SCALE = 256
#: Quantised components below this are held in 64-bit integers: 2 ** 11 squares of differences of them fit a long.
WIDE = 1 << 26
LIMB = 24
#: Relative rounding error that a bound may have: the leading coordinates are stored as 32-bit floats.
SLACK = 1e-6
LONG = (-(1 << 63), (1 << 63) - 1)


def taken(embeddings: DataFrame, width: int, id_column: str, vector_column: str) -> DataFrame:
    """(id, x array<double>): the vectors that take part."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    rows = embeddings.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("x"))
    return rows.where(F.coalesce((F.size("x") == width) & F.forall("x", finite), F.lit(False)))


def whole(x: float) -> int:
    """floor(SCALE * x), also where the product is beyond a double."""
    scaled = x * SCALE
    return math.floor(scaled) if math.isfinite(scaled) else int(x) * SCALE


def _doubles(column) -> np.ndarray:
    """Rows of a list<double> column as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _narrow(x: np.ndarray) -> np.ndarray:
    """Which rows stay below WIDE once quantised."""
    return (np.abs(x) < WIDE / SCALE).all(axis=1)


def principal_axes(rows: DataFrame, width: int) -> np.ndarray:
    """Eigenvectors of the second moments of all rows, the strongest first; a task sends one matrix, added up on Spark.

    Rows are scaled down where they are huge, so that no moment overflows; that only changes how well the axes fit.
    """

    def moments(batches):
        total = np.zeros((width, width))
        for batch in batches:
            x = np.clip(_doubles(batch.column(0)), -WIDE, WIDE)
            total += x.T @ x
        i, j = np.indices((width, width))
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], names=["i", "j", "s"])

    sums = rows.select("x").mapInArrow(moments, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    matrix = np.zeros((width, width))
    for r in sums.collect():  # width x width numbers
        matrix[r["i"], r["j"]] = r["s"]
    return np.linalg.eigh(matrix)[1][:, ::-1].copy()


def stored(rows: DataFrame, axes: np.ndarray, leading: int) -> DataFrame:
    """(id, x, q array<int>, lead array<float>, rest): x only for wide rows, the others only for narrow ones."""

    def run(batches):
        for batch in batches:
            x = _doubles(batch.column(1))
            narrow = _narrow(x)
            q = np.floor(np.where(narrow[:, None], x, 0.0) * SCALE).astype(np.int32)
            turned = q.astype(float) @ axes
            lead, rest = turned[:, :leading], np.sqrt((turned[:, leading:] ** 2).sum(axis=1))

            def lists(values: np.ndarray, mask: np.ndarray) -> pa.Array:
                sizes = np.where(mask, values.shape[1], 0)
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                return pa.ListArray.from_arrays(offsets, pa.array(values[mask].ravel()))

            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists(x, ~narrow), lists(q, narrow), lists(lead.astype(np.float32), narrow), pa.array(rest)],
                names=["id", "x", "q", "lead", "rest"],
            )

    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(run, f"id {kind}, x array<double>, q array<int>, lead array<float>, rest double")


class Centroids(NamedTuple):
    """Whole-number centroids, bounded by their number, and what the filter needs of them."""

    values: tuple[tuple[int, ...], ...]
    axes: np.ndarray
    leading: int

    def split(self) -> tuple[list[int], list[int]]:
        """Numbers of the centroids that fit the 64-bit path, and of the others."""
        fits = [all(abs(v) < WIDE for v in c) for c in self.values]
        return [i for i, f in enumerate(fits) if f], [i for i, f in enumerate(fits) if not f]


def _exact(row, centroid) -> int:
    return sum((a - b) * (a - b) for a, b in zip(row, centroid))


def assign_narrow(q: np.ndarray, lead: np.ndarray, rest: np.ndarray, c: Centroids) -> tuple[np.ndarray, list[int] | np.ndarray, int]:
    """Cluster and squared distance of each row, and how many exact distances that took."""
    small, large = c.split()
    n = len(q)
    if small:
        whole_c = np.array([c.values[i] for i in small], np.int64)
        turned = whole_c.astype(float) @ c.axes
        near, far = turned[:, : c.leading], np.sqrt((turned[:, c.leading :] ** 2).sum(axis=1))
        lengths, own = (lead**2).sum(axis=1), (near**2).sum(axis=1)
        bound = lengths[:, None] + own[None, :] - 2 * (lead @ near.T) + (rest[:, None] - far[None, :]) ** 2
        bound -= SLACK * (lengths[:, None] + own[None, :] + rest[:, None] ** 2 + far[None, :] ** 2)
        first = bound.argmin(axis=1)
        wide = q.astype(np.int64)
        best = ((wide - whole_c[first]) ** 2).sum(axis=1)
        i, j = np.nonzero(bound <= best[:, None].astype(float) * (1 + SLACK))
        distance = np.empty(len(i), np.int64)
        for at in range(0, len(i), 1 << 16):
            part = slice(at, at + (1 << 16))
            distance[part] = ((wide[i[part]] - whole_c[j[part]]) ** 2).sum(axis=1)
        # rows come in order, and within a row centroids do; the stable sort leaves the smaller number first among equals
        order = np.lexsort((j, distance, i))
        lead_at = np.concatenate([[True], i[order][1:] != i[order][:-1]]) if n else np.zeros(0, bool)
        chosen, least = np.array(small)[j[order][lead_at]], distance[order][lead_at]
        if not large:
            return chosen, least, len(i)
        chosen, least, measured = chosen.tolist(), least.tolist(), len(i)
    else:
        chosen, least, measured = [None] * n, [None] * n, 0
    for r, row in enumerate(q.tolist()):
        for k in large:
            d = _exact(row, c.values[k])
            measured += 1
            if least[r] is None or (d, k) < (least[r], chosen[r]):
                chosen[r], least[r] = k, d
    return np.array(chosen, np.int64), least, measured


def assign_wide(x: np.ndarray, c: Centroids) -> tuple[list[int], list[int], list[list[int]]]:
    """Cluster, squared distance and whole components of rows beyond the 64-bit path, by Python integers."""
    rows = [[whole(v) for v in row] for row in x.tolist()]
    found = [min((_exact(row, v), k) for k, v in enumerate(c.values)) for row in rows]
    return [k for _, k in found], [d for d, _ in found], rows


def _parts(batch):
    """The narrow rows' matrices and the wide rows' one, with where they stand in the batch."""
    long = batch.column(2).value_lengths().to_numpy(zero_copy_only=False) > 0
    at, off = np.flatnonzero(long), np.flatnonzero(~long)
    take = lambda k, where: batch.column(k).take(pa.array(where))
    q = take(2, at).flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)
    return at, off, q, _doubles(take(3, at)).astype(float) if len(at) else None, take(4, at).to_numpy(), _doubles(take(1, off)) if len(off) else None


def _fits(values) -> pa.Array:
    if isinstance(values, np.ndarray):
        return pa.array(values)
    return pa.array([v if LONG[0] <= v <= LONG[1] else None for v in values], pa.int64())


def assigned(table: DataFrame, c: Centroids) -> DataFrame:
    """(id, cluster, distance) of every stored row."""

    def run(batches):
        for batch in batches:
            at, off, q, lead, rest, x = _parts(batch)
            for where, make in ((at, lambda: assign_narrow(q, lead, rest, c)), (off, lambda: assign_wide(x, c))):
                if len(where):
                    cluster, distance, _ = make()
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(where)), pa.array(cluster, pa.int32()), _fits(distance)],
                        names=["id", "cluster", "distance"],
                    )

    return table.mapInArrow(run, f"id {dict(table.dtypes)['id']}, cluster int, distance long")


def limbs(value: int):
    """Limbs of 24 bits, the lowest first; the last one carries the sign."""
    k = 0
    while not -WIDE <= value < WIDE:
        yield k, value & ((1 << LIMB) - 1)
        value >>= LIMB
        k += 1
    yield k, value


def moved(table: DataFrame, c: Centroids) -> Centroids:
    """The centroids after one round: floor of the mean of their vectors; a centroid without vectors stays."""
    k, width = len(c.values), len(c.values[0])

    def sums(batches):
        total, count, rest = np.zeros((k, width), np.int64), np.zeros(k, np.int64), {}
        for batch in batches:
            at, off, q, lead, near, x = _parts(batch)
            if len(at):
                cluster = assign_narrow(q, lead, near, c)[0]
                order = np.argsort(cluster, kind="stable")
                heads = np.flatnonzero(np.diff(cluster[order], prepend=-1))
                total[cluster[order][heads]] += np.add.reduceat(q[order].astype(np.int64), heads, axis=0)
                count += np.bincount(cluster, minlength=k)
            if len(off):
                for n, _, row in zip(*assign_wide(x, c)):
                    count[n] += 1
                    for j, value in enumerate(row):
                        for limb, part in limbs(value):
                            key = (n, j, limb)
                            rest[key] = rest.get(key, 0) + part
        used = np.flatnonzero(count)
        rows = [(int(n), -1, 0, int(count[n])) for n in used]
        rows += [(int(n), j, 0, int(total[n, j])) for n in used for j in range(width)]
        rows += [(*key, part) for key, part in rest.items()]
        columns = [pa.array(v, t) for v, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.int64()))]
        if rows:
            yield pa.RecordBatch.from_arrays(columns, names=["cluster", "j", "limb", "part"])

    added = table.mapInArrow(sums, "cluster int, j int, limb int, part long").groupBy("cluster", "j", "limb").agg(F.sum("part").alias("part"))
    found: dict[tuple[int, int], int] = {}
    for r in added.collect():  # at most k x (width + 1) sums, times the limbs of a double
        key = (r["cluster"], r["j"])
        found[key] = found.get(key, 0) + (r["part"] << LIMB * r["limb"])
    values = [
        tuple(found[n, j] // found[n, -1] for j in range(width)) if (n, -1) in found else old for n, old in enumerate(c.values)
    ]
    return c._replace(values=tuple(values))


def first_centroids(rows: DataFrame, k: int, seed: str) -> list[tuple[int, ...]]:
    """The k vectors whose `<seed>:<id>` has the smallest SHA-256, in that order."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    least = rows.where(F.col("id").isNotNull()).select(mark.alias("mark"), "x").orderBy("mark", "x").limit(k)
    return [tuple(whole(v) for v in r["x"]) for r in least.collect()]


def cluster(
    embeddings: DataFrame, k: int = 40, rounds: int = 5, width: int = 64, seed: str = "2", leading: int = 48,
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part."""
    spark = embeddings.sparkSession
    rows = taken(embeddings, width, id_column, vector_column)
    start = first_centroids(rows, k, seed)
    kind = dict(rows.dtypes)["id"]
    if not start:
        empty = f"`{id_column}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], empty)
    axes = principal_axes(rows, width)
    table = cut_lineage(stored(rows, axes, leading), "rotated-vectors")
    c = Centroids(tuple(start), axes, leading)
    for _ in range(rounds):
        c = moved(table, c)
    placed = cut_lineage(assigned(table, c), "clusters")
    return placed.join(F.broadcast(_summary(spark, placed, c)), "cluster").select(
        F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _summary(spark: SparkSession, placed: DataFrame, c: Centroids) -> DataFrame:
    """(cluster, cluster_inertia, inertia, centroid_sha256), one row per centroid."""
    total = F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    missing = F.count(F.when(F.col("distance").isNull(), 1)).alias("missing")
    found = {r["cluster"]: None if r["missing"] else int(r["total"]) for r in placed.groupBy("cluster").agg(total, missing).collect()}
    whole_sum = None if None in found.values() else sum(found.values())
    fit = lambda v: v if v is not None and v <= LONG[1] else None
    rows = [
        (n, fit(found[n]), fit(whole_sum), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest())
        for n, v in enumerate(c.values)
        if n in found
    ]
    return spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")

"""Centroid clustering over zone maps in the order of a space-filling curve.

Vectors become integers; a Hilbert curve through their leading principal axes orders them, and neighbours on the curve
go into blocks that are written once, each with the box that holds it: the least and greatest coordinate along each of these
axes, and the greatest distance from the space that they span. A pass over the blocks bounds by how much any point of the
box can be nearer to a centroid than to the one nearest the box's middle; if it can't, no member is assigned to it. The
others are compared exactly, a block at once. Passes shuffle only sums by cluster and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Tables

#: Vectors in a block; axes of the curve and bits of each.
BLOCK, CURVE_AXES, CURVE_BITS = 256, 8, 7
#: Greatest absolute component, so that squared distances fit a long.
MOST = 1 << 27
#: Rows of a batch from which blocks are made.
BATCH_ROWS = 16_384


def on_lattice(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """(vec_id, q): vectors of exactly `dims` finite components as integers floor(scale * x); all others are left out."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    far = F.raise_error(F.lit(f"a component beyond {MOST}: squared distances need not fit a long"))
    whole: Column = F.transform(v, lambda x: F.when(F.abs(x * float(scale)) <= float(MOST), F.floor(x * float(scale)).cast("int")).otherwise(far.cast("int")))
    return vectors.filter((F.size(v) == dims) & finite).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("q"))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A list column without nulls as rows of integers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points with `bits` bits in each component, by the transposed form of the curve."""
    x = cells.T.astype(np.int64).copy()
    n = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        for i in range(n):
            high = x[i] & q != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(high, q - 1, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        flip ^= np.where(x[n - 1] & q != 0, q - 1, 0)
    x ^= flip
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            place = place << 1 | x[i] >> b & 1
    return place


def principal_axes(rows: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, leading axes and their deviations, from sums of products; they order the vectors and decide no result."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims + 1))
        for batch in batches:
            x = np.c_[np.ones(batch.num_rows), matrix(batch.column(0), dims)]
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "v"])

    sums = np.zeros((dims + 1) ** 2)
    for r in rows.select("q").mapInArrow(moments, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
        sums[r.at] = r.v
    sums = sums.reshape(dims + 1, -1) / max(sums[0], 1)
    mean = sums[0, 1:]
    values, axes = np.linalg.eigh(sums[1:, 1:] - np.outer(mean, mean))
    lead = np.argsort(-values)[:CURVE_AXES]
    return mean, axes[:, lead], np.sqrt(np.maximum(values[lead], 1e-9))


class Frame:
    """Leading axes through the mean, and coordinates in them."""

    def __init__(self, mean: np.ndarray, axes: np.ndarray) -> None:
        self.mean, self.axes = mean, axes

    def coordinates(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Coordinates along the axes, and the distance from their space with what rounding may add to it."""
        centred = x - self.mean
        along, square = centred @ self.axes, (centred * centred).sum(1)
        return along, np.sqrt(np.maximum(square - (along * along).sum(1), 0) + 1e-12 * square)


def zone_map(rows: DataFrame, dims: int) -> tuple[DataFrame, Frame]:
    """One row for each block of up to BLOCK neighbours on the curve: ids, their components (4 bytes each), lo, hi and rest."""
    mean, axes, spread = principal_axes(rows, dims)
    frame = Frame(mean, axes)
    top = (1 << CURVE_BITS) - 1

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = (matrix(batch.column(1), dims) - mean) @ axes / (6 * spread) + 0.5
            place = hilbert(np.clip(x * (top + 1), 0, top).astype(np.int64), CURVE_BITS)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], names=["vec_id", "q", "place"])

    # Equal vectors share a place; the number of the row splits them over ranges.
    ordered = rows.mapInArrow(placed, "vec_id long, q array<int>, place long").withColumn("tie", F.monotonically_increasing_id())
    ordered = ordered.repartitionByRange("place", "tie").sortWithinPartitions("place", "tie").select("vec_id", "q")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, ids, out = matrix(batch.column(1), dims), batch.column(0), []
            for k in range(0, batch.num_rows, BLOCK):
                part = x[k : k + BLOCK]
                along, rest = frame.coordinates(part)
                out.append((ids.slice(k, BLOCK).to_pylist(), part.astype("<i4").tobytes(), along.min(0).tolist(), along.max(0).tolist(), float(rest.max())))
            kinds = [pa.list_(pa.int64()), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["ids", "q", "lo", "hi", "rest"])

    return ordered.mapInArrow(blocks, "ids array<long>, q binary, lo array<double>, hi array<double>, rest double"), frame


def candidates(lo: np.ndarray, hi: np.ndarray, rest: float, centroids: np.ndarray, frame: Frame) -> np.ndarray:
    """Numbers of the centroids that can be nearest to a point of the box.

    The difference of a point's squared distances to two centroids is linear in the point, so its least value over the box is
    taken axis by axis; off the axes it is bounded by lengths. Rounding is on the side of keeping a centroid.
    """
    c = centroids - frame.mean
    along, squares = c @ frame.axes, (c * c).sum(1)
    middle = (lo + hi) / 2
    pivot = int((squares - 2 * along @ middle).argmin())
    apart = c - c[pivot]
    step = along - along[pivot]
    off = np.sqrt(np.maximum((apart * apart).sum(1) - (step * step).sum(1), 0) + 1e-12 * squares.max())
    most = np.maximum(lo * step, hi * step).sum(1) + rest * off
    slack = 1e-9 * (squares.max() + np.maximum(lo * lo, hi * hi).sum() + rest * rest) + 1e-6
    return np.flatnonzero(squares - squares[pivot] - 2 * most <= slack)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number of the nearest centroid (the first of equals) and its squared distance, in exact integers."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if 4 * x.shape[1] * most * most < 1 << 53:  # exact in doubles too, where products are fast
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        d = ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)).astype(np.int64)
    else:
        d = np.stack([((x - c) ** 2).sum(1) for c in centroids], 1)
    best = d.argmin(1)
    return best, d[np.arange(len(x)), best]


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray, frame: Frame) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """For each block: ids, components, number of the nearest centroid and squared distance."""
    dims = centroids.shape[1]
    for ids, q, lo, hi, rest in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
        x = np.frombuffer(q, "<i4").astype(np.int64).reshape(-1, dims)
        among = candidates(np.array(lo), np.array(hi), rest, centroids, frame)
        best, d = nearest(x, centroids[among])
        yield ids, x, among[best], d


def update(blocks: DataFrame, centroids: np.ndarray, frame: Frame) -> np.ndarray:
    """Centroids after one round: exact floors of the means of their vectors; those without a vector stay."""
    k, dims = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), np.int64)
        for batch in batches:
            for _, x, cluster, _ in _assigned(batch, centroids, frame):
                for c in np.unique(cluster):
                    mine = x[cluster == c]
                    total[c, 0] += len(mine)
                    total[c, 1:] += mine.sum(0)
        at = np.flatnonzero(total[:, 0].repeat(dims + 1))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total.ravel()[at], pa.int64())], names=["at", "v"])

    out = [[0] * (dims + 1) for _ in range(k)]
    for r in blocks.mapInArrow(sums, "at long, v long").groupBy("at").agg(F.sum("v").alias("v")).collect():
        out[r.at // (dims + 1)][r.at % (dims + 1)] = r.v
    return np.array([[s // row[0] for s in row[1:]] if row[0] else old for row, old in zip(out, centroids.tolist(), strict=True)], np.int64)


def cluster(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: str = "1") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 for each vector of `dims` finite components.

    Vectors that are null, of another length or with a null or non-finite component are left out. The first centroids are
    the vectors of least sha256 of `seed:vec_id` (null ids last, equal ones by their components), so repeated rows count one
    by one; fewer than k vectors give fewer centroids, and none an empty table. Equal distances go to the smaller number.
    Components beyond 2^27 after scaling raise an error. k and dims are bounded parameters: k * dims numbers go to each task.
    """
    spark = vectors.sparkSession
    rows = on_lattice(vectors, id_col, vector_col, dims, scale)
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = rows.withColumn("h", order).orderBy(F.col("h").asc_nulls_last(), "q").limit(k).select("q").collect()
    schema = "vec_id long, cluster int, distance long"
    if not first:
        names = ("cluster_inertia long", "inertia long", "centroid_sha256 string")
        return spark.createDataFrame([], ", ".join([schema, *names]))
    centroids = np.array([r.q for r in first], np.int64)
    tables = Tables(spark)
    blocks, frame = zone_map(rows, dims)
    blocks = tables.keep(blocks)
    for _ in range(rounds):
        centroids = update(blocks, centroids, frame)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, _, number, d in _assigned(batch, centroids, frame):
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(number.astype(np.int32)), pa.array(d)], names=["vec_id", "cluster", "distance"])

    table = tables.keep(blocks.mapInArrow(final, schema), instead_of=(blocks,))
    own = {r.cluster: r.s for r in table.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    each = spark.createDataFrame([(c, s, sum(own.values()), digest[c]) for c, s in own.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return table.join(F.broadcast(each), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

"""Exact centroid clustering over a vector approximation file.

The file holds every vector twice: as cells of four bits a component, two to a byte, and in
full. For given centroids, a table says for each byte how much its two cells add at least and
at most to the squared distance from each centroid; adding up a vector's bytes gives an interval
per centroid. Where one interval lies below all others the nearest centroid is known; only where
intervals overlap is the full vector compared, and only with the centroids that are left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import prepare, stored

N_CLUSTERS = 40
ROUNDS = 5
DIMENSIONS = 64
SEED = 2
SCALE = 256

# Cells per component; two cells make a byte.
CELLS = 16
# Vectors, first by hash, whose components say where cells are cut. Cells only decide how many
# full vectors are compared, never the result.
SAMPLE = 4096
# Components beyond this have squared distances that may not fit a long.
MOST = 1 << 27


def whole_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, column: str = "embedding") -> DataFrame:
    """vec_id and ``point``, its components as integers floor(256 x), of the usable vectors.

    Left out: null vectors, other numbers of components, null, NaN or infinite components.
    A component beyond 2^27 after scaling is an error, as its distances have no long.
    """
    values = vectors[column].cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))

    def scaled(x):
        too_far = F.raise_error(F.concat(F.lit("component without a long distance: "), x.cast("string")))
        return F.when(F.abs(x * SCALE) <= MOST, F.floor(x * SCALE).cast("int")).otherwise(too_far.cast("int"))

    return vectors.where((F.size(values) == dimensions) & finite).select(
        vectors["vec_id"].cast("long").alias("vec_id"), F.transform(values, scaled).alias("point")
    )


def first_by_hash(points: DataFrame, n: int, seed: int = SEED) -> np.ndarray:
    """The ``n`` vectors with smallest sha256 of ``seed:vec_id``, in that order (ties: by components)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    order = F.sha2(name.cast("binary"), 256)
    rows = points.select("point", order.alias("hash")).orderBy("hash", "point").limit(n).collect()
    return np.array([r["point"] for r in rows], np.int64)


def _points(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("point"))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.int64)


def write_cells(points: DataFrame, cuts: np.ndarray) -> DataFrame:
    """The approximation file: vec_id, cells and point, stored in the shared folder.

    ``cuts`` has CELLS - 1 ascending bounds per component; cell c holds the values from bound
    c - 1 on and below bound c. An odd number of components is filled up with cell 0.
    """
    pairs = -(-len(cuts) // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _points(batch)
            cells = np.zeros((len(values), 2 * pairs), np.uint8)
            for d, bounds in enumerate(cuts):
                cells[:, d] = np.searchsorted(bounds, values[:, d], side="right")
            packed = cells[:, ::2] << 4 | cells[:, 1::2]
            made = pa.array([row.tobytes() for row in packed], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), made, batch.column(1)], ["vec_id", "cells", "point"])

    return stored(points.mapInArrow(run, "vec_id bigint, cells binary, point array<int>"), "cells")


def extremes(file: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of each component: one pass, one row per component in the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if not batch.num_rows:
                continue
            values = _points(batch)
            low = values.min(0) if low is None else np.minimum(low, values.min(0))
            high = values.max(0) if high is None else np.maximum(high, values.max(0))
        if low is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(low))), pa.array(low), pa.array(high)], ["component", "low", "high"]
            )

    parts = file.select("point").mapInArrow(run, "component bigint, low bigint, high bigint")
    rows = parts.groupBy("component").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    rows.sort(key=lambda r: r["component"])
    return np.array([r["low"] for r in rows]), np.array([r["high"] for r in rows])


class Intervals:
    """Lookup tables of what each byte of cells adds to the squared distance from each centroid."""

    def __init__(self, centroids: np.ndarray, cuts: np.ndarray, low: np.ndarray, high: np.ndarray):
        k = len(centroids)
        self.centroids = centroids
        # ends of each component's cells, the outer ones closed by the extremes
        start = np.column_stack((low, cuts))
        end = np.column_stack((cuts - 1, high))
        c = centroids.T[:, None, :]
        start, end = start[:, :, None], end[:, :, None]
        below, above = np.maximum(start - c, 0), np.maximum(c - end, 0)
        least = np.maximum(below, above) ** 2
        most = np.maximum(np.abs(start - c), np.abs(end - c)) ** 2
        both = np.concatenate((least, most), axis=2)
        if len(both) % 2:
            both = np.concatenate((both, np.zeros((1, CELLS, 2 * k), both.dtype)))
        tables = (both[::2, :, None] + both[1::2, None, :]).reshape(len(both) // 2, CELLS * CELLS, 2 * k)
        # narrow numbers as long as no sum can pass them
        narrow = tables.max(axis=(1, 2)).sum() < 2**31 if tables.size else True
        self.tables = tables.astype(np.int32 if narrow else np.int64)

    def bounds(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest squared distance of each vector from each centroid."""
        total = np.zeros((len(cells), self.tables.shape[2]), self.tables.dtype)
        for column, table in zip(cells.T, self.tables):
            total += table[column]
        k = len(self.centroids)
        return total[:, :k], total[:, k:]

    def nearest(self, cells: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, int]:
        """Nearest centroid of each vector (ties: the smaller number), and how many were compared."""
        least, most = self.bounds(cells)
        left = least <= most.min(axis=1, keepdims=True)
        cluster = left.argmax(axis=1)
        open_rows = np.flatnonzero(left.sum(axis=1) > 1)
        row, centroid = np.nonzero(left[open_rows])
        gap = points[open_rows][row] - self.centroids[centroid]
        distance = np.full((len(open_rows), len(self.centroids)), np.iinfo(np.int64).max)
        distance[row, centroid] = np.einsum("ij,ij->i", gap, gap)
        cluster[open_rows] = distance.argmin(axis=1)
        return cluster, len(open_rows)


def _each(file: DataFrame, intervals: Intervals, make: type) -> DataFrame:
    """What a ``make`` object of each task yields for the task's batches, and at its end."""
    shared = file.sparkSession.sparkContext.broadcast(intervals)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, state = shared.value, make()
        for batch in batches:
            if batch.num_rows:
                points = _points(batch)
                packed = batch.column(batch.schema.get_field_index("cells"))
                cells = np.frombuffer(b"".join(packed.to_pylist()), np.uint8).reshape(len(points), -1)
                cluster, compared = tables.nearest(cells, points)
                yield from state.batch(batch, tables, points, cluster, compared)
        yield from state.end()

    return file.mapInArrow(run, make.schema)


class _Sums:
    """A task's sum of components, count and number of compared vectors per cluster."""

    schema = "cluster int, totals array<bigint>"

    def __init__(self):
        self.totals = None

    def batch(self, batch, tables, points, cluster, compared):
        k = len(tables.centroids)
        if self.totals is None:
            self.totals = np.zeros((k, points.shape[1] + 2), np.int64)
        order = np.argsort(cluster, kind="stable")
        seen, first = np.unique(cluster[order], return_index=True)
        self.totals[seen, :-2] += np.add.reduceat(points[order], first)
        self.totals[:, -2] += np.bincount(cluster, minlength=k)
        self.totals[0, -1] += compared
        return ()

    def end(self):
        if self.totals is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(self.totals)), pa.int32()), pa.array(list(self.totals), pa.list_(pa.int64()))],
                ["cluster", "totals"],
            )


class _Assigned:
    """One row per vector: its cluster and squared distance."""

    schema = "vec_id bigint, cluster int, distance bigint"

    def batch(self, batch, tables, points, cluster, compared):
        gap = points - tables.centroids[cluster]
        distance = np.einsum("ij,ij->i", gap, gap)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(cluster, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"]
        )

    def end(self):
        return ()


def next_centroids(file: DataFrame, intervals: Intervals) -> tuple[np.ndarray, int]:
    """Means (floor) of the vectors nearest to each centroid; clusters without any keep theirs.

    Tasks add up their vectors, Spark adds up the tasks; the driver gets one row per cluster
    and component. Also returns how many full vectors had to be compared.
    """
    k, dimensions = intervals.centroids.shape
    parts = _each(file, intervals, _Sums)
    sums = parts.select("cluster", F.posexplode("totals").alias("component", "total"))
    rows = sums.groupBy("cluster", "component").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    total = {(r["cluster"], r["component"]): int(r["total"]) for r in rows}
    made = intervals.centroids.copy()
    for c in range(k):
        n = total.get((c, dimensions), 0)
        if n:
            made[c] = [total[c, d] // n for d in range(dimensions)]
    return made, total.get((0, dimensions + 1), 0)


def cluster(
    vectors: DataFrame,
    n_clusters: int = N_CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    seed: int = SEED,
) -> DataFrame:
    """Assign every usable vector to one of ``n_clusters`` centroids after ``rounds`` rounds.

    Returns per usable vector (``whole_vectors``): vec_id, cluster, distance (squared),
    cluster_inertia, inertia and centroid_sha256. Centroids start as the vectors first by hash;
    with fewer vectors than clusters every vector starts one. Repeated rows count as often as
    they stand, null ids hash as the empty text, equal hashes are ordered by components; a table
    without usable vectors gives an empty result. Other columns are left out, whatever their names.

    Centroids, tables and sums are bounded by the parameters; vectors never leave their tasks but
    for the bounded sample that starts centroids and cuts cells. Nothing but sums is shuffled.
    """
    spark = prepare(vectors.sparkSession)
    points = whole_vectors(vectors, dimensions)
    sample = first_by_hash(points, max(SAMPLE, n_clusters), seed)
    empty = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not len(sample):
        return spark.createDataFrame([], empty)
    parts = np.arange(1, CELLS) / CELLS
    cuts = np.quantile(sample, parts, axis=0, method="nearest").T.astype(np.int64)
    file = write_cells(points, cuts)
    low, high = extremes(file)
    centroids = sample[:n_clusters]
    for _ in range(rounds):
        centroids, _ = next_centroids(file, Intervals(centroids, cuts, low, high))
    final = stored(_each(file, Intervals(centroids, cuts, low, high), _Assigned), "assigned")
    sums = final.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    total = sum(int(r["inertia"]) for r in sums)
    names = {c: hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for c, row in enumerate(centroids.tolist())}
    known = [(r["cluster"], int(r["inertia"]), total, names[r["cluster"]]) for r in sums]
    per_cluster = spark.createDataFrame(
        known, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    return final.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )

"""Centroid clustering over a VA-file: vectors as few-bit cells per dimension, distance intervals from lookup tables.

The VA-file holds each vector's cells (BITS bits per dimension, two dimensions a byte) beside the vector. Every dimension
has its own cuts, the mean over all rows of the quantiles of their batches, closed by the exact extremes of all rows. For a
set of centroids the tables give, per pair of dimensions and byte, the least and the largest squared distance of anything in
these cells to each centroid; their sums are an interval per vector and centroid. A centroid whose interval begins beyond the
nearest end of another's cannot be nearest. Where one centroid is left the vector is assigned by its cells; only where
intervals overlap is it fetched, and only its distances to the centroids that are left are computed.

A round's exact sums need every vector of a cluster once, so the cells travel in the same scan as the vectors and no vector is
shuffled: each task adds its own clusters, and a row per task, cluster and dimension is all that meets.

Defined results: vectors of another length, with a NULL or non-finite component, or NULL themselves are left out; integers
beyond +-2^27 count as that bound, as squared distances are 64-bit; rows with a repeated id are vectors of their own, and
those without an id are seeds only after all others; equal hashes go by the vector; with fewer vectors than centroids there
are as many centroids as vectors; no vector, no row; extra columns are ignored. Sums and means are exact at any size.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeplan.llm import common

BITS = 4
CELLS = 1 << BITS
BOUND = 1 << 27


@dataclass(frozen=True)
class Cells:
    """Smallest and largest integer of each cell, per dimension."""

    low: np.ndarray
    high: np.ndarray

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """Cells of each vector, two dimensions a byte."""
        cell = np.zeros(vectors.shape, np.uint8)
        for d in range(vectors.shape[1]):
            cell[:, d] = np.searchsorted(self.low[d, 1:], vectors[:, d], side="right")
        if cell.shape[1] % 2:
            cell = np.column_stack([cell, np.zeros(len(cell), np.uint8)])
        return cell[:, ::2] << np.uint8(BITS) | cell[:, 1::2]

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances to each centroid, at least and at most, by pair of dimensions and byte."""
        gap = centroids.T[:, None, :]
        below, above = self.low[:, :, None] - gap, gap - self.high[:, :, None]
        least = np.maximum(np.maximum(below, above), 0) ** 2
        most = np.maximum(np.abs(below), np.abs(above)) ** 2
        if len(least) % 2:
            least, most = (np.concatenate([t, np.zeros_like(t[:1])]) for t in (least, most))
        return tuple((t[::2, :, None] + t[1::2, None]).reshape(len(t) // 2, CELLS * CELLS, -1) for t in (least, most))


def integers(components: np.ndarray, scale: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(components * scale), -BOUND, BOUND).astype(np.int64)


def rows_of(column: pa.Array, kind) -> np.ndarray:
    """Binary values of one length as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def kept_vectors(df: DataFrame, dims: int, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, vector): rows with exactly ``dims`` finite components."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), F.lit(False)))
    return df.filter((F.size(vector) == dims) & finite).select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("vector"))


def numbers(batch: pa.RecordBatch, scale: int) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("vector"))
    return integers(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1), scale)


def fitted_cells(kept: DataFrame, dims: int, scale: int) -> Cells | None:
    """Cuts from all rows; they decide how much is fetched, never a result."""
    def run(batches):
        low, high = np.full(dims, BOUND, np.int64), np.full(dims, -BOUND, np.int64)
        cuts, rows = np.zeros((dims, CELLS - 1)), 0
        for batch in batches:
            if len(batch):
                v = numbers(batch, scale)
                low, high = np.minimum(low, v.min(0)), np.maximum(high, v.max(0))
                cuts += np.quantile(v, np.arange(1, CELLS) / CELLS, axis=0).T * len(v)
                rows += len(v)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(low), pa.array(high), pa.array([rows] * dims), pa.array(list(cuts))],
                                             names=["dim", "low", "high", "n", "cuts"])

    partial = common.map_arrow(kept.select("vector"), run, "dim long, low long, high long, n long, cuts array<double>")
    sums = [F.sum(F.col("cuts")[i]).alias(f"c{i}") for i in range(CELLS - 1)]
    found = partial.groupBy("dim").agg(F.min("low"), F.max("high"), F.sum("n"), *sums).orderBy("dim").collect()
    if not found:
        return None
    low, high = np.zeros((dims, CELLS), np.int64), np.zeros((dims, CELLS), np.int64)
    for r in found:
        cuts = np.ceil(np.array(r[4:]) / r[3]).astype(np.int64)
        low[r.dim] = np.concatenate([[r[1]], np.clip(cuts, r[1], r[2])])
        high[r.dim] = np.append(np.maximum(low[r.dim, 1:] - 1, low[r.dim, :-1]), r[2])
    return Cells(low, high)


def va_file(kept: DataFrame, cells: Cells, scale: int) -> DataFrame:
    """(vec_id, cells, vector), written: the index over every kept row."""
    def run(batches):
        for batch in batches:
            v = numbers(batch, scale) if len(batch) else np.zeros((0, 2), np.int64)
            packed = [row.tobytes() for row in cells.of(v)] if len(batch) else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary()), pa.array([row.tobytes() for row in v.astype(np.int32)], pa.binary())],
                                             names=["vec_id", "cells", "vector"])

    return common.written(common.map_arrow(kept, run, "vec_id long, cells binary, vector binary"), "va-file")


def seeds(index: DataFrame, k: int, salt: str) -> np.ndarray:
    """The vectors whose hashed ids are smallest."""
    order = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    picked = index.orderBy(order.asc_nulls_last(), "vector").limit(k).select("vector").collect()
    return np.stack([np.frombuffer(r.vector, np.int32) for r in picked]).astype(np.int64)


class Nearest:
    """Assigns batches of cells and vectors to centroids; counts what it fetched."""

    def __init__(self, cells: Cells, centroids: np.ndarray):
        self.centroids = centroids
        self.least, self.most = cells.tables(centroids)
        self.fetched = self.distances = 0

    def open_pairs(self, packed: np.ndarray) -> np.ndarray:
        """Which centroids the cells leave possible, per vector."""
        least = np.zeros((len(packed), len(self.centroids)), np.int64)
        most = np.zeros_like(least)
        for pair in range(packed.shape[1]):
            least += self.least[pair][packed[:, pair]]
            most += self.most[pair][packed[:, pair]]
        return least <= most.min(1)[:, None]

    def assign(self, packed: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        possible = self.open_pairs(packed)
        cluster = possible.argmax(1)
        overlap = np.flatnonzero(possible.sum(1) > 1)
        if len(overlap):
            fetched = vectors[overlap].astype(np.int64)
            at, centroid = np.nonzero(possible[overlap])
            distance = np.full((len(overlap), len(self.centroids)), np.iinfo(np.int64).max)
            distance[at, centroid] = ((fetched[at] - self.centroids[centroid]) ** 2).sum(1)
            cluster[overlap] = distance.argmin(1)
            self.fetched += len(overlap)
            self.distances += len(at)
        return cluster


def moved_centroids(index: DataFrame, cells: Cells, centroids: np.ndarray) -> np.ndarray:
    """Exact means, rounded down, of each cluster's vectors; an empty cluster keeps its centroid."""
    k, dims = centroids.shape

    def run(batches):
        near = Nearest(cells, centroids)
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if len(batch):
                vectors = rows_of(batch.column(1), np.int32)
                cluster = near.assign(rows_of(batch.column(0), np.uint8), vectors)
                order = np.argsort(cluster, kind="stable")
                present, starts = np.unique(cluster[order], return_index=True)
                sums[present] += np.add.reduceat(vectors[order].astype(np.int64), starts)
                counts += np.bincount(cluster, minlength=k)
        c, d = np.nonzero(np.repeat(counts[:, None] > 0, dims, 1))
        yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(d), pa.array(sums[c, d]), pa.array(counts[c])], names=["cluster", "dim", "s", "n"])

    partial = common.map_arrow(index.select("cells", "vector"), run, "cluster long, dim long, s long, n long")
    moved = centroids.copy()
    for r in partial.groupBy("cluster", "dim").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect():
        moved[r.cluster, r.dim] = int(r.s) // r.n
    return moved


def assigned(index: DataFrame, cells: Cells, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    def run(batches):
        near = Nearest(cells, centroids)
        for batch in batches:
            if len(batch):
                vectors = rows_of(batch.column(2), np.int32)
                cluster = near.assign(rows_of(batch.column(1), np.uint8), vectors)
                distance = ((vectors.astype(np.int64) - centroids[cluster]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster, pa.int32()), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return common.map_arrow(index, run, "vec_id long, cluster int, distance long")


def overlap_share(index: DataFrame, cells: Cells, centroids: np.ndarray) -> tuple[int, int, int]:
    """(vectors, vectors fetched, distances computed) of one assignment."""
    def run(batches):
        near, n = Nearest(cells, centroids), 0
        for batch in batches:
            if len(batch):
                near.assign(rows_of(batch.column(0), np.uint8), rows_of(batch.column(1), np.int32))
                n += len(batch)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([near.fetched]), pa.array([near.distances])], names=["n", "fetched", "distances"])

    counted = common.map_arrow(index.select("cells", "vector"), run, "n long, fetched long, distances long")
    return tuple(counted.agg(F.sum("n"), F.sum("fetched"), F.sum("distances")).first())


def clusters(df: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, salt: str = "1",
             vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector."""
    spark = df.sparkSession
    kept = kept_vectors(df, dims, vec_id, vector)
    cells = fitted_cells(kept, dims, scale)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if cells is None:
        return spark.createDataFrame([], schema)
    index = va_file(kept, cells, scale)
    centroids = seeds(index, k, salt)
    for _ in range(rounds):
        centroids = moved_centroids(index, cells, centroids)
    placed = common.written(assigned(index, cells, centroids), "assigned")
    own = {r.cluster: int(r.s) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    rows = [(c, s, sum(own.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in own.items()]
    known = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

"""Clustering around centroids in exact integers, by a progressive search over Walsh-Hadamard coefficients.

Vectors of ``SIZE`` components become integers, ``floor(SCALE * x)``. The transform of integers is
exact, and the squared distance of two vectors is the sum of their squared coefficient differences over ``SIZE``.
A search adds up these differences coarse to fine, in order of the number of sign changes: after the first
``STAGES`` the nearest centroid so far is finished, and from then on every centroid whose sum is already
larger than that one's whole distance is eliminated. What is never worse is finished on all coefficients, so the nearest
centroid and its distance are exact, and ties go to the smaller number.

A round is one pass over the written integer vectors. A task sends at most one row of sums per centroid, Spark
adds them up, and only the sums (``k`` rows of ``SIZE`` numbers) reach the driver; so a cluster that holds a
third of all vectors is a sum like any other.

Defined results: vectors that are null, of another length, or that hold null or non-finite components are
no part of the result; components are held within ``+-LARGEST`` after scaling, so that distances fit a long; an inertia that does not is null;
with fewer than ``k`` vectors each of them starts a centroid; a start is the row of the smallest hash of its
id, equal hashes (repeated ids) by their components, null ids after all others; equal vectors are rows of
their own; an empty centroid stays where it is; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.sources.storage import Scratch, staged

SIZE = 64
SCALE = 1024
LARGEST = 2**24
CLUSTERS = 8
ROUNDS = 10
SEED = 3
# Coefficients that a step of the search adds, coarse to fine.
STAGES = (4, 4, 8, 16, 32)
CHUNK = 8192


def hadamard(size: int = SIZE) -> np.ndarray:
    """The transform of a power of two, rows ordered by their number of sign changes."""
    matrix = np.array([[1]])
    while len(matrix) < size:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    return matrix[np.argsort((np.diff(matrix, axis=1) != 0).sum(axis=1))]


_TRANSFORM = hadamard().T.astype(np.float64)


def transformed(vectors: np.ndarray) -> np.ndarray:
    """Exact coefficients: sums of 64 integers below 2**24 are exact in doubles, and quick."""
    return (vectors.astype(np.float64) @ _TRANSFORM).astype(np.int64)


def nearest(coefficients: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid and squared distance, from transformed vectors and centroids."""
    count, k = len(coefficients), len(centroids)
    sums = np.zeros((count, k), np.int64)
    open_ = np.ones((count, k), bool)
    bound = None
    at = 0
    for step in STAGES:
        here = slice(at, at + step)
        for c in range(k):
            rows = np.flatnonzero(open_[:, c])
            apart = coefficients[rows, here] - centroids[c, here]
            sums[rows, c] += np.einsum("ij,ij->i", apart, apart)
        at += step
        if bound is None:
            leader = sums.argmin(axis=1)
            apart = coefficients[:, at:] - centroids[leader][:, at:]
            bound = sums[np.arange(count), leader] + np.einsum("ij,ij->i", apart, apart)
        open_ &= sums <= bound[:, None]
    finished = np.where(open_, sums, np.iinfo(np.int64).max)
    chosen = finished.argmin(axis=1)
    return chosen, finished[np.arange(count), chosen] // SIZE


def integers(vectors: DataFrame) -> DataFrame:
    """``vec_id, cells`` of the vectors that count: their integer components, 4 bytes each."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")) \
        .where((F.size("v") == SIZE) & finite)

    def scaled(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            cells = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, SIZE)
            whole = np.clip(np.floor(cells * SCALE), -LARGEST, LARGEST).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([row.tobytes() for row in whole], pa.binary())], names=["vec_id", "cells"])

    return kept.mapInArrow(scaled, "vec_id long, cells binary")


def starts(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The components of the ``k`` rows with the smallest hash of their id."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(order.asc_nulls_last(), "cells").limit(k).collect()
    return np.array([np.frombuffer(row.cells, np.int32) for row in rows], np.int64).reshape(-1, SIZE)


def _matrix(cells) -> np.ndarray:
    return np.frombuffer(b"".join(cells.to_pylist()), np.int32).reshape(-1, SIZE).astype(np.int64)


def _sums(centroids: np.ndarray):
    """Count and component sums of every centroid's vectors, one row per centroid and task."""
    goal = transformed(centroids)

    def run(batches) -> Iterator:
        import pyarrow as pa

        counts, sums = np.zeros(len(goal), np.int64), np.zeros((len(goal), SIZE), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                vectors = _matrix(batch.column("cells").slice(at, CHUNK))
                chosen, _ = nearest(transformed(vectors), goal)
                counts += np.bincount(chosen, minlength=len(goal))
                for c in range(len(goal)):
                    sums[c] += vectors[chosen == c].sum(axis=0)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int64()), pa.array(counts[some], pa.int64()), pa.array(list(sums[some]), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"])

    return run


def improved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after a round: the floor of the mean of their vectors; empty ones stay."""
    parts = vectors.select("cells").mapInArrow(_sums(centroids), "cluster long, n long, sums array<long>")
    total = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(SIZE)))
    moved = centroids.copy()
    for row in total.collect():  # at most one row per centroid
        moved[row[0]] = [value // row[1] for value in row[2:]]
    return moved


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` (squared) of every vector."""
    goal = transformed(centroids)

    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                chosen, distance = nearest(transformed(_matrix(part.column("cells"))), goal)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array(chosen, pa.int32()), pa.array(distance, pa.int64())],
                    names=["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, "vec_id long, cluster int, distance long")


def fit(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """Centroids of integer vectors (see ``integers``) after ``rounds`` rounds, one row each."""
    centroids = starts(vectors, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = improved(vectors, centroids)
    return centroids


def clusters(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """Per kept vector ``vec_id, cluster, distance, cluster_inertia, inertia, centroid`` (its components)."""
    spark = vectors.sparkSession
    with Scratch(spark) as scratch:
        whole = scratch.staged(integers(vectors), "integers")
        centroids = fit(whole, k, rounds, seed)
        found = staged(assigned(whole, centroids), "assigned")
    sums = dict(found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38)"))).collect())  # a row per centroid

    def fitting(value) -> int | None:
        return int(value) if value < 2**63 else None

    facts = spark.createDataFrame(
        [(c, fitting(value), fitting(sum(sums.values())), [int(x) for x in centroids[c]]) for c, value in sorted(sums.items())],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return found.join(F.broadcast(facts), "cluster").select(  # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")

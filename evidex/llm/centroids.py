"""Centroid clustering of integer vectors by a bisector tournament.

For two centroids i < j the plane half-way between them has the integer normal 2 * (c_j - c_i) and the integer threshold
|c_j|^2 - |c_i|^2. A vector on its positive side is nearer to j; on the plane the smaller number wins. The normals and
thresholds of all pairs are computed once a round. A vector then needs k - 1 sign tests: the centroid that is left from
the numbers before meets the next one, and the loser is out. Only the distance to the last one left is computed.

Vectors are packed once into tiles in the shared folder and never move again. A task of a round hands on one row of sums
per centroid, whatever the sizes of the clusters, so that a cluster with a third of all rows is no hot key; at most k
rows come back to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidex.llm.common import arrow_schema, stored_table
from evidex.llm.tiles import cells_of, packed, usable

ROWS_PER_TILE = 8_192
ROWS_PER_TEST = 2_048
EXACT = 2**53

_ASSIGNED = arrow_schema(id=pa.int64(), cluster=pa.int32(), distance=pa.int64())


class Tournament:
    """The nearest of k integer centroids by k - 1 sign tests, with the planes of all pairs computed beforehand."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids.astype(np.int64)
        squares = (self.centroids**2).sum(axis=1)
        normals = 2 * (self.centroids[None, :, :] - self.centroids[:, None, :])
        thresholds = squares[None, :] - squares[:, None]
        self.largest = int(np.abs(normals).max(initial=0)) * centroids.shape[1]
        self.bound = int(np.abs(thresholds).max(initial=0))
        self.planes = {np.int64: (normals, thresholds), np.float64: (normals.astype(np.float64), thresholds.astype(np.float64))}

    def nearest(self, cells: np.ndarray) -> np.ndarray:
        """Numbers of the nearest centroids; equal distances go to the smaller number."""
        # Doubles hold every product and sum exactly below 2^53; beyond that 64-bit integers do (see `cell_limit`).
        kind = np.float64 if self.largest * int(np.abs(cells).max(initial=0)) + self.bound < EXACT else np.int64
        normals, thresholds = self.planes[kind]
        out = np.zeros(len(cells), np.int64)
        for at in range(0, len(cells), ROWS_PER_TEST):
            block, left = cells[at : at + ROWS_PER_TEST].astype(kind), out[at : at + ROWS_PER_TEST]
            for j in range(1, len(self.centroids)):
                side = np.einsum("nd,nd->n", block, normals[left, j]) - thresholds[left, j]
                left[side > 0] = j
        return out

    def distances(self, cells: np.ndarray, nearest: np.ndarray) -> np.ndarray:
        """Exact squared distances to the given centroids."""
        return ((cells.astype(np.int64) - self.centroids[nearest]) ** 2).sum(axis=1)


def cell_limit(dim: int) -> int:
    """Cells are held within this size, so that a plane's products and a squared distance fit into 64 bits."""
    return isqrt(2**60 // max(1, dim))


def _cluster_sums(tournament: Tournament, dim: int):
    """Per task one row for each of its clusters: rows and the sum of every component."""
    schema = arrow_schema(cluster=pa.int32(), n=pa.int64(), sums=pa.list_(pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(tournament.centroids)
        sums, counts = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for ids, blob in zip(batch.column("ids"), batch.column("cells")):
                cells = cells_of(blob.as_py(), len(ids.as_py()) // 8)
                nearest = tournament.nearest(cells)
                order = np.argsort(nearest, kind="stable")
                found, starts = np.unique(nearest[order], return_index=True)
                sums[found] += np.add.reduceat(cells[order].astype(np.int64), starts, axis=0)
                counts += np.bincount(nearest, minlength=k)
        rows = [(int(c), int(counts[c]), sums[c].tolist()) for c in np.flatnonzero(counts)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def _assign(tournament: Tournament):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, missing, blob in zip(batch.column("ids"), batch.column("missing"), batch.column("cells")):
                names = np.frombuffer(ids.as_py(), np.int64)
                cells = cells_of(blob.as_py(), names.size)
                nearest = tournament.nearest(cells)
                names = pa.array(names, mask=np.frombuffer(missing.as_py(), np.bool_))
                columns = [names, pa.array(nearest.astype(np.int32)), pa.array(tournament.distances(cells, nearest))]
                yield pa.RecordBatch.from_arrays(columns, schema=_ASSIGNED)

    return run


def _next_centroids(tiles: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The floor of each cluster's mean, exactly; a centroid without vectors stays as it is."""
    dim = centroids.shape[1]
    sums = tiles.select("ids", "cells").mapInArrow(_cluster_sums(Tournament(centroids), dim), "cluster int, n long, sums array<long>")
    # Decimals, as the sum over all tasks may leave 64 bits where that of one task does not.
    totals = [F.sum(F.col("sums")[d].cast("decimal(20,0)")).alias(f"s{d}") for d in range(dim)]
    out = centroids.copy()
    for row in sums.groupBy("cluster").agg(F.sum("n").alias("n"), *totals).collect():
        out[row["cluster"]] = [int(row[f"s{d}"]) // row["n"] for d in range(dim)]
    return out


def cluster_vectors(
    vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: float = 256.0, seed: str = "2:",
    vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """k-means over floor(scale * x) with integer centroids: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Starts from the k vectors with the smallest lower-case hex SHA-256 of `seed` and the id, in that order (of equal ids
    the smaller vector first). Each round assigns every vector to the nearest centroid (ties: the smaller number) and
    replaces a centroid with vectors by the floor of their mean; then they are assigned once more.

    Vectors that are null, have another length, or hold a null or non-finite component take no part. Repeated rows are
    vectors of their own; a row without an id is clustered but never a start. With fewer than k rows there are as many
    centroids; no rows with an id give no rows. Finite components whose cell leaves +-cell_limit(dim) (1.3e8 for 64
    components) are held at it. Sums of distances beyond a bigint stand at its largest value. Other columns are ignored.
    """
    spark = vectors.sparkSession
    kept = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    kept = kept.filter(usable("v") & (F.size("v") == dim))
    tiles = stored_table(packed(kept, ROWS_PER_TILE, scale, cell_limit), "vectors")

    first = kept.filter(F.col("id").isNotNull()).withColumn("order", F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")).cast("binary"), 256))
    starts = first.orderBy("order", "v").limit(k).collect()
    if not starts:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    limit = cell_limit(dim)
    centroids = np.clip(np.floor(scale * np.array([r["v"] for r in starts], np.float64)), -limit, limit).astype(np.int64)
    for _ in range(rounds):
        centroids = _next_centroids(tiles, centroids)

    names = [(c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids.tolist())]
    assigned = stored_table(tiles.mapInArrow(_assign(Tournament(centroids)), "id long, cluster int, distance long"), "assigned")
    # At most k rows of sums, one per cluster, so that they are sent to all tasks and no row of a cluster moves.
    sums = {r["cluster"]: int(r["total"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("total")).collect()}
    most = 2**63 - 1
    rows = [(c, min(most, sums[c]), min(most, sum(sums.values())), sha) for c, sha in names if c in sums]
    per_cluster = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = assigned.withColumnRenamed("id", "vec_id").join(F.broadcast(per_cluster), "cluster")
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

"""k-means by cosine distance for many cells, by matrix products.

Vectors are scaled to length 1, rounded to multiples of 2^-24 and stored once as bytes, a row each. A pass over them
multiplies a block of rows with all centres; a task hands on one row of sums per cell it has seen, whatever the size of the
cell. Sums of such multiples are exact, so they do not depend on the order of the rows. The start is k-means||: two
rounds that each pick about 2k rows by their cost, weights by the nearest of them, then weighted k-means++ on the driver.
What is picked depends on a hash of the row, not on the files it stands in; a row that lies between two centres within the
error of single precision may go to either. At most some 4k vectors come back to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidex.operators.vectors import SCORES_PER_STEP, _steps, _unit_rows
from evidex.session import Intermediate, fill_cores, small_arrow_batches

# Fixed values (defaults the results depend on).
GRID = 2.0**24
START_ROUNDS = 2
PICKED_PER_ROUND = 2
LOCAL_ROUNDS = 30
TOLERANCE = 1e-4

# Rounds after which no further vectors are looked for, where fewer than k different ones were found.
MOST_ROUNDS = 12
BYTES_PER_BATCH = 4 * 1024 * 1024

_SUMS = pa.schema([("cell", pa.int32()), ("n", pa.int64()), ("sums", pa.binary())])
_SUMS_DDL = "cell int, n bigint, sums binary"


def _bytes_of(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], type=pa.binary())


def _rows_of(column: pa.Array, dim: int) -> np.ndarray:
    """The matrix of a column of vectors of one length; nothing is copied."""
    data, start = column.buffers()[2], column.offset
    offsets = np.frombuffer(column.buffers()[1], np.int32)
    return np.frombuffer(data, np.float32, len(column) * dim, int(offsets[start])).reshape(-1, dim)


def packed(df: DataFrame, dim: int) -> DataFrame:
    """(draw, cells) of rows (draw, vector): the bytes of the unit vector; rows without a direction are left out."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _steps(batches):
            rows, vectors = _unit_rows(batch.column("vector"))
            if rows.size == 0:
                continue
            if vectors.shape[1] != dim:
                raise ValueError("vectors of different length in one training")
            cells = (np.rint(vectors * GRID) / GRID).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column("draw").take(pa.array(rows)), _bytes_of(cells)], names=["draw", "cells"])

    return df.mapInArrow(pack, "draw bigint, cells binary")


def nearest(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Numbers of the nearest centres, in blocks of at most SCORES_PER_STEP products."""
    out, step = np.empty(len(rows), np.int64), max(1, SCORES_PER_STEP // len(centers))
    for start in range(0, len(rows), step):
        np.argmax(rows[start : start + step] @ centers.T, axis=1, out=out[start : start + step])
    return out


def _costs(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Half the squared distance to the nearest centre, which is the cosine distance; exactly 0 for a copy of it."""
    apart = rows - centers[nearest(rows, centers)]
    return 0.5 * np.einsum("nd,nd->n", apart, apart, dtype=np.float64)


def _cell_sums(rows: np.ndarray, cells: np.ndarray, sums: np.ndarray) -> None:
    order = np.argsort(cells, kind="stable")
    found, starts = np.unique(cells[order], return_index=True)
    sums[found] += np.add.reduceat(rows[order], starts, axis=0, dtype=np.float64)


def _sum_batches(counts: np.ndarray, sums: np.ndarray, names: np.ndarray) -> Iterator[pa.RecordBatch]:
    step = max(1, BYTES_PER_BATCH // (8 * sums.shape[1]))
    for start in range(0, len(names), step):
        part = slice(start, start + step)
        columns = [pa.array(names[part], type=pa.int32()), pa.array(counts[part], type=pa.int64()), _bytes_of(sums[part])]
        yield pa.RecordBatch.from_arrays(columns, schema=_SUMS)


class Training:
    """The stored vectors and the passes over them."""

    def __init__(self, rows: DataFrame, dim: int):
        self.rows, self.dim = rows, dim
        self.spark = rows.sparkSession
        # A task hands on up to k sums: a few tasks per core, however many splits there are.
        self.tasks = 4 * self.spark.sparkContext.defaultParallelism

    def _pass(self, make, centers: np.ndarray, ddl: str, *columns: str) -> DataFrame:
        dim, sent = self.dim, self.spark.sparkContext.broadcast(np.ascontiguousarray(centers, dtype=np.float32))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from make(((b, _rows_of(b.column("cells"), dim)) for b in batches if b.num_rows), sent.value)

        return self.rows.select(*columns, "cells").coalesce(self.tasks).mapInArrow(run, ddl)

    def costs(self, centers: np.ndarray) -> DataFrame:
        """(draw, cost) of every row."""

        def make(blocks, own):
            for batch, rows in blocks:
                yield pa.RecordBatch.from_arrays([batch.column("draw"), pa.array(_costs(rows, own))], names=["draw", "cost"])

        return self._pass(make, centers, "draw bigint, cost double", "draw")

    def weights(self, centers: np.ndarray) -> np.ndarray:
        """How many rows are nearest to each centre."""

        def make(blocks, own):
            counts = np.zeros(len(own), np.int64)
            for _, rows in blocks:
                counts += np.bincount(nearest(rows, own), minlength=len(own))
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(counts[seen])], names=["cell", "n"])

        out = np.zeros(len(centers), np.int64)
        found = self._pass(make, centers, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
        out[np.asarray(found["cell"])] = np.asarray(found["n"])
        return out

    def means(self, centers: np.ndarray) -> np.ndarray:
        """The direction of each cell's sum; a cell without rows or without a direction keeps its centre."""
        dim = self.dim

        def make(blocks, own):
            sums, counts = np.zeros(own.shape), np.zeros(len(own), np.int64)
            for _, rows in blocks:
                cells = nearest(rows, own)
                _cell_sums(rows, cells, sums)
                counts += np.bincount(cells, minlength=len(own))
            seen = np.flatnonzero(counts)
            yield from _sum_batches(counts[seen], sums[seen], seen)

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, list] = {}
            for batch in batches:
                for cell, n, sums in zip(*(c.to_pylist() for c in batch.columns)):
                    own = held.setdefault(cell, [0, np.zeros(dim)])
                    own[0] += n
                    own[1] += np.frombuffer(sums)
            if held:
                names = np.asarray(list(held))
                yield from _sum_batches(np.asarray([n for n, _ in held.values()]), np.stack([s for _, s in held.values()]), names)

        found = self._pass(make, centers, _SUMS_DDL).repartition("cell").mapInArrow(merge, _SUMS_DDL).toArrow()
        out = centers.copy()
        for cell, sums in zip(found["cell"].to_pylist(), found["sums"]):
            total = np.frombuffer(sums.as_buffer())
            norm = np.linalg.norm(total)
            if norm > 0:
                out[cell] = total / norm
        return out

    def first(self) -> np.ndarray:
        return np.frombuffer(self.rows.orderBy("draw").select("cells").first()[0], np.float32)

    def picked(self, centers: np.ndarray, k: int, number: int) -> list[bytes]:
        """The vectors that a round picks: each row with a probability of 2k times its share of all costs."""
        with Intermediate(self.spark) as steps:
            costs = steps.stored(self.costs(centers), "costs")
            total = costs.agg(F.sum("cost")).first()[0]
            if not total:
                return []
            place = F.pmod(F.xxhash64("draw", F.lit(number)), F.lit(2**53)) / F.lit(float(2**53))
            chosen = costs.filter(place * F.lit(total) < F.col("cost") * F.lit(float(PICKED_PER_ROUND * k))).select("draw").distinct()
            # About 2k draws; copies of a vector are one.
            own = self.rows.join(F.broadcast(chosen), "draw").select("cells").distinct().toArrow()
        return sorted(c.as_py() for c in own["cells"])


def start(training: Training, k: int, seed: int) -> np.ndarray:
    """k different vectors to begin with; as many as there are, if they are fewer."""
    found, number = [training.first().tobytes()], 0
    while number < START_ROUNDS or (len(found) < k and number < MOST_ROUNDS):
        known = set(found)
        more = [c for c in training.picked(_matrix(found, training.dim), k, number) if c not in known]
        found, number = found + more, number + 1
        if not more:
            break
    vectors = _matrix(found, training.dim)
    return vectors.astype(np.float64) if len(found) <= k else weighted_kmeans(vectors, training.weights(vectors), k, seed)


def _matrix(found: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(found), np.float32).reshape(-1, dim)


def weighted_kmeans(vectors: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k unit centres of a few vectors with weights: k-means++ and then at most LOCAL_ROUNDS rounds."""
    draw, weights = np.random.default_rng(seed), weights.astype(np.float64)

    def one_of(mass: np.ndarray) -> int:
        ends = np.cumsum(mass)
        return min(int(np.searchsorted(ends, draw.random() * ends[-1], side="right")), len(mass) - 1)

    chosen = [one_of(weights)]
    cost = np.full(len(vectors), np.inf)
    for _ in range(k - 1):
        cost = np.minimum(cost, np.maximum(1.0 - vectors @ vectors[chosen[-1]], 0.0))
        cost[chosen[-1]] = 0.0
        mass = cost * weights
        # Without a cost that counts, any vector that is not chosen yet will do.
        chosen.append(one_of(mass) if mass.sum() > 0 else int(np.setdiff1d(np.arange(len(vectors)), chosen)[0]))
    centers, before = vectors[chosen].astype(np.float64), None
    for _ in range(LOCAL_ROUNDS):
        cells = nearest(vectors, centers.astype(np.float32))
        if before is not None and (cells == before).all():
            break
        sums = np.zeros(centers.shape)
        for at in range(0, len(vectors), 4096):
            part = slice(at, at + 4096)
            _cell_sums(vectors[part] * weights[part, None], cells[part], sums)
        norms, before = np.linalg.norm(sums, axis=1), cells
        for empty in np.flatnonzero(np.bincount(cells, minlength=k) == 0):
            sums[empty], norms[empty] = vectors[draw.integers(len(vectors))], 1.0
        centers = np.where(norms[:, None] > 0, sums / np.where(norms > 0, norms, 1.0)[:, None], centers)
    return centers


def train(df: DataFrame, k: int, dim: int, seed: int, max_iter: int) -> np.ndarray:
    """Unit centres of the rows (draw, vector), where `draw` is a hash that picks them; at most k, if so many differ."""
    small_arrow_batches(df.sparkSession)
    with Intermediate(df.sparkSession) as steps:
        training = Training(steps.stored(packed(fill_cores(df, "draw"), dim), "units"), dim)
        centers = start(training, k, seed)
        for _ in range(max_iter):
            before, centers = centers, training.means(centers)
            if (1.0 - np.einsum("kd,kd->k", before, centers) <= TOLERANCE).all():
                break
    return centers / np.linalg.norm(centers, axis=1, keepdims=True)

"""Exact search over cells: cells are read in the order of their bounds until no unread one can hold a nearer row.

Angles obey the triangle inequality. If all rows of a cell lie between two angles of a pivot, a query at another angle of
that pivot is at least the gap away from each of them. Pivots are the cell's own centre (its radius) and some of the other
centres; the largest gap counts. With that the k nearest rows are found whatever cells they lie in, and the cells that
are not read are known to hold none of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidex.operators.groups import topk_per_group
from evidex.operators.ivf import CENTROID_BYTES
from evidex.operators.vectors import (
    BROADCAST_QUERIES, SEARCH_K, TopK, _hit_schema, _one_array, _repeats, _scan_with_broadcast, _unit_rows, bounded_rows, drop_empty_vectors, search,
)
from evidex.session import stored

PIVOTS = 64

# What rounding may take off a bound: distances have nine digits, and an angle near 0 only half of a double's.
MARGIN = 1e-7


@dataclass
class CellBounds:
    """Between which angles of its pivots the rows of each cell lie; the first pivot of a cell is its own centre."""

    centers: np.ndarray
    pivots: np.ndarray
    cells: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def distances(self, queries: np.ndarray) -> np.ndarray:
        """Lower bounds of the distance from each unit query to the rows of each cell."""
        others = _angles(queries, self.centers[self.pivots])
        own = _angles(queries, self.centers[self.cells])
        gap = np.maximum(self.low[None, :, 0] - own, own - self.high[None, :, 0])
        for p in range(len(self.pivots)):
            angle = others[:, p, None]
            gap = np.maximum(gap, np.maximum(self.low[None, :, p + 1] - angle, angle - self.high[None, :, p + 1]))
        return 1.0 - np.cos(np.clip(gap, 0.0, np.pi))

    def until(self, order: np.ndarray, distance: np.ndarray, seen: int, kth: float, k: int, first: int) -> int:
        """How many cells of its order a query has read after the next round; `seen` when it is done.

        At first those that hold k rows, and `first` at least; then as many again as were read, while their bounds allow
        a row as near as the k-th so far.
        """
        if seen == 0:
            return min(len(order), max(first, int(np.searchsorted(np.cumsum(self.rows[order]), k)) + 1))
        return max(seen, min(2 * seen, int(np.searchsorted(distance, kth + MARGIN, side="right"))))

    def in_order(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the cells of each query, the smallest bound first, and their bounds."""
        bounds = self.distances(queries)
        order = np.argsort(bounds, axis=1, kind="stable")
        return order, np.take_along_axis(bounds, order, axis=1)


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1.0, 1.0))


def spread_pivots(n_centers: int, pivots: int = PIVOTS) -> np.ndarray:
    """Numbers of the centres that are pivots of all cells, evenly spread and few enough to be sent to all tasks."""
    most = max(1, min(pivots, n_centers, CENTROID_BYTES // (16 * n_centers)))
    return np.unique(np.linspace(0, n_centers - 1, most).round().astype(int))


def cell_angles(cells: DataFrame, centers: np.ndarray, vector: str = "vector", pivots: int = PIVOTS) -> DataFrame:
    """(cell, pivot, n_rows, low, high): the angles between which a cell's rows lie, seen from each pivot.

    `cells` are rows with a `cell` from `assign_cells`. The pivot -1 is the cell's own centre. A task hands on one row
    per cell and pivot that it has met, so that large cells stay spread.
    """
    chosen = spread_pivots(len(centers), pivots)
    names = np.concatenate([[-1], chosen])
    sent = cells.sparkSession.sparkContext.broadcast((centers, centers[chosen]))
    slim = drop_empty_vectors(cells.select(F.col("cell").cast("int").alias("cell"), F.col(vector).alias("vector")))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_centers, pivot_centers = sent.value
        held: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            rows, vectors = _unit_rows(batch.column("vector"))
            if rows.size == 0:
                continue
            cell = np.asarray(batch.column("cell").take(pa.array(rows)))
            own = np.arccos(np.clip((vectors * all_centers[cell]).sum(axis=1), -1.0, 1.0))
            angle = np.column_stack([own, _angles(vectors, pivot_centers)])
            for c in np.unique(cell):
                inside = angle[cell == c]
                n, low, high = len(inside), inside.min(axis=0), inside.max(axis=0)
                if int(c) in held:
                    before = held[int(c)]
                    n, low, high = n + before[0], np.minimum(low, before[1]), np.maximum(high, before[2])
                held[int(c)] = (n, low, high)
        for c, (n, low, high) in held.items():
            columns = [np.full(len(names), c, np.int32), names.astype(np.int32), np.full(len(names), n), low, high]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["cell", "pivot", "n_rows", "low", "high"])

    parts = slim.mapInArrow(measure, "cell int, pivot int, n_rows bigint, low double, high double")
    return parts.groupBy("cell", "pivot").agg(F.sum("n_rows").alias("n_rows"), F.min("low").alias("low"), F.max("high").alias("high"))


def cell_bounds(angles: DataFrame, centers: np.ndarray) -> CellBounds:
    """The rows of `cell_angles`, at most cells x pivots, as arrays that a search sends to its tasks."""
    table = angles.orderBy("cell", "pivot").toArrow()
    cell, pivot = np.asarray(table["cell"]), np.asarray(table["pivot"])
    cells, pivots = np.unique(cell), np.unique(pivot[pivot >= 0])
    shape = (len(cells), len(pivots) + 1)
    own = pivot == -1
    return CellBounds(
        centers, pivots, cells, np.asarray(table["n_rows"])[own], np.asarray(table["low"]).reshape(shape), np.asarray(table["high"]).reshape(shape)
    )


def cells_in_order(queries: DataFrame, bounds: CellBounds, query_id: str = "query_id", query_vector: str = "vector") -> DataFrame:
    """(query_id, cell, n_rows, bound, place) of all cells for each query, the smallest bound first."""
    slim = drop_empty_vectors(queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).alias("vector")))
    id_type = slim.schema["query_id"].dataType.simpleString()
    sent = slim.sparkSession.sparkContext.broadcast(bounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = sent.value
        n = len(b.cells)
        for batch in batches:
            rows, vectors = _unit_rows(batch.column("vector"))
            if rows.size == 0 or n == 0:
                continue
            order, distance = b.in_order(vectors)
            at = order.reshape(-1)
            columns = [batch.column("query_id").take(pa.array(np.repeat(rows, n))), pa.array(b.cells[at].astype(np.int32)), pa.array(b.rows[at])]
            columns += [pa.array(distance.reshape(-1)), pa.array(np.tile(np.arange(1, n + 1, dtype=np.int32), len(rows)))]
            yield pa.RecordBatch.from_arrays(columns, names=["query_id", "cell", "n_rows", "bound", "place"])

    return slim.mapInArrow(run, f"query_id {id_type}, cell int, n_rows bigint, bound double, place int")


def _next_cells(state: DataFrame, bounds: CellBounds, k: int, first: int) -> DataFrame:
    """(query_id, cell): the next cells that each query (query_id, vector, kth, seen) has to read, none when it is done."""
    id_type = state.schema["query_id"].dataType.simpleString()
    sent = state.sparkSession.sparkContext.broadcast(bounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = sent.value
        for batch in batches:
            rows, vectors = _unit_rows(batch.column("vector"))
            if rows.size == 0 or len(b.cells) == 0:
                continue
            orders, distances = b.in_order(vectors)
            names, cells = [], []
            for row, order, distance in zip(rows, orders, distances):
                kth, seen = batch.column("kth")[int(row)].as_py(), batch.column("seen")[int(row)].as_py()
                following = order[seen : b.until(order, distance, seen, kth, k, first)]
                names += [int(row)] * len(following)
                cells.append(b.cells[following])
            ids = batch.column("query_id").take(pa.array(names, type=pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.concatenate(cells).astype(np.int32))], names=["query_id", "cell"])

    return state.mapInArrow(run, f"query_id {id_type}, cell int")


def _few_queries(slim: DataFrame, wanted: DataFrame, held: pa.Table, bounds: CellBounds, k: int, first: int) -> tuple[DataFrame, DataFrame]:
    """Queries that fit into a broadcast: what each has found and read is kept here, at most k rows per query."""
    spark = slim.sparkSession
    if _repeats(wanted, held):
        raise ValueError("a query id comes twice")
    ddl, arrow = _hit_schema(wanted, "query_id", slim, "item_id")
    rows, matrix = _unit_rows(_one_array(held, "vector"))
    if rows.size == 0 or len(bounds.cells) == 0:
        return spark.createDataFrame([], f"{ddl}, rank int"), spark.createDataFrame([], "query_id string, cells_read bigint, rows_read bigint")
    held = held.take(pa.array(rows))
    names = held["query_id"].to_pylist()
    number = {name: n for n, name in enumerate(names)}
    orders, distances = bounds.in_order(matrix)
    seen, top = np.zeros(len(names), int), TopK(matrix, k)
    while True:
        until = [bounds.until(o, d, s, limit, k, first) for o, d, s, limit in zip(orders, distances, seen, top.limit)]
        pairs = [(names[q], int(bounds.cells[c])) for q, o in enumerate(orders) for c in o[seen[q] : until[q]]]
        if not pairs:
            break
        seen = np.array(until)
        probes = pa.table({"query_id": pa.array([q for q, _ in pairs], type=arrow.field("query_id").type), "cell": pa.array([c for _, c in pairs], type=pa.int32())})
        near = slim.filter(F.col("cell").isin(sorted({c for _, c in pairs})))
        found = _scan_with_broadcast(near, held, probes, k, ddl, arrow)
        best = topk_per_group(found, ["query_id"], [F.col("distance"), F.col("item_id")], k).toArrow().to_pandas()
        for name, hits in best.groupby("query_id", sort=False):
            ids = np.empty(len(hits), dtype=object)
            ids[:] = hits["item_id"].tolist()
            top._merge(number[name], hits["distance"].to_numpy(), ids)
    out = [(names[q], i, float(d), rank) for q, b in enumerate(top.best) if b for rank, (d, i) in enumerate(zip(*b), 1)]
    taken = [(names[q], int(n), int(bounds.rows[orders[q][:n]].sum())) for q, n in enumerate(seen)]
    cost = f"query_id {wanted.schema['query_id'].dataType.simpleString()}, cells_read bigint, rows_read bigint"
    return spark.createDataFrame(out, f"{ddl}, rank int"), spark.createDataFrame(taken, cost)


def bounded_topk(
    cells: DataFrame,
    queries: DataFrame,
    bounds: CellBounds,
    k: int = SEARCH_K,
    first: int = 1,
    item_id: str = "item_id",
    query_id: str = "query_id",
    vector: str = "vector",
    query_vector: str = "vector",
    max_broadcast: int = BROADCAST_QUERIES,
    **limits: int,
) -> tuple[DataFrame, DataFrame]:
    """The exact k nearest rows per query, as `vector_topk` has them, and (query_id, cells_read, rows_read) it took.

    `cells` are the rows with their cell, of which `bounds` were taken: stored by `write_cells`, only the folders of the
    cells that a round needs are opened. Each round doubles the cells a query has read; the rounds end when no query has
    an unread cell whose bound is within its k-th distance.
    """
    wanted = drop_empty_vectors(queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).alias("vector")))
    held = bounded_rows(wanted, max_broadcast)
    if held is not None:
        slim = cells.select(F.col(item_id).alias("item_id"), F.col(vector).alias("vector"), F.col("cell").cast("int").alias("cell"))
        return _few_queries(drop_empty_vectors(slim), wanted, held, bounds, k, first)
    wanted = stored(wanted, "queries")
    state = wanted.withColumns({"kth": F.lit(float("inf")), "seen": F.lit(0)})
    hits, read = None, None
    while True:
        probes = stored(_next_cells(state, bounds, k, first), "probes")
        read = probes if read is None else read.unionByName(probes)
        if hits is not None and probes.isEmpty():
            break
        now = wanted if hits is None else wanted.join(probes.select("query_id").distinct(), "query_id", "left_semi")
        found = search(cells, now, k, item_id, "query_id", vector, "vector", probes=probes, max_broadcast=max_broadcast, **limits)[0].drop("rank")
        both = found if hits is None else hits.drop("rank").unionByName(found)
        hits = stored(topk_per_group(both, ["query_id"], [F.col("distance"), F.col("item_id")], k), "hits")
        # A query with fewer than k rows so far goes on whatever the bounds are.
        so_far = hits.groupBy("query_id").agg(F.when(F.count("*") == k, F.max("distance")).otherwise(float("inf")).alias("kth"))
        seen = read.groupBy("query_id").agg(F.count("*").cast("int").alias("seen"))
        state = wanted.join(so_far, "query_id", "left").join(seen, "query_id", "left")
        state = state.withColumns({"kth": F.coalesce("kth", F.lit(float("inf"))), "seen": F.coalesce("seen", F.lit(0))})
    spark = cells.sparkSession
    sizes = spark.createDataFrame([(int(c), int(n)) for c, n in zip(bounds.cells, bounds.rows)], "cell int, n_rows bigint")
    cost = read.join(F.broadcast(sizes), "cell").groupBy("query_id").agg(F.count("*").alias("cells_read"), F.sum("n_rows").alias("rows_read"))
    return hits, cost


__all__ = ["CellBounds", "bounded_topk", "cell_angles", "cell_bounds", "cells_in_order", "spread_pivots"]

"""Inverted-file search: vectors are sorted into cells, a query only reads its nearest cells."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidex.functions.scalars import SEED
from evidex.operators import kmeans
from evidex.operators.vectors import (
    DISTANCE_DIGITS,
    NUMBERS_PER_STEP,
    SCORES_PER_STEP,
    SEARCH_K,
    _unit_rows,
    drop_empty_vectors,
    search,
)
from evidex.session import Intermediate, small_arrow_batches

# Fixed values (defaults the results depend on).
GROWTH_THRESHOLD_PCT = 15.0
MIN_INDEX_ROWS = 1

# Centroids are broadcast: more of them than this is an error.
CENTROID_BYTES = 512 * 1024 * 1024


def default_cells(rows: int) -> int:
    return max(1, int(math.sqrt(rows)))


def train_cells(
    base: DataFrame,
    n_cells: int | None = None,
    vector: str = "vector",
    seed: int = SEED,
    max_iter: int = 10,
    training_share: float = 1.0,
) -> np.ndarray:
    """Unit centroids from k-means with cosine distance; every row gets a cell later, whatever they were trained on.

    `training_share` of the rows, picked by the hash of their vector, takes part in the training. As many cells as asked
    for (by default the root of the number of rows) are made, or it is an error.
    """
    # What is picked to start from depends on the whole row, so that copies of a vector are rows of their own.
    hashed = [c for c, kind in base.dtypes if "map<" not in kind and "variant" not in kind]
    usable = drop_empty_vectors(base.select(F.xxhash64(*hashed, F.lit(seed)).alias("draw"), F.col(vector).alias("vector")))
    usable = usable.filter(F.exists("vector", lambda x: x != 0))
    rows, size = usable.select(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    n_cells = n_cells or default_cells(rows)
    if n_cells > rows:
        raise ValueError(f"{n_cells} cells for {rows} vectors with a direction")
    if n_cells * size * 8 > CENTROID_BYTES:
        raise ValueError(f"{n_cells} centroids of {size} dimensions are more than {CENTROID_BYTES} bytes")
    kept = F.pmod(F.xxhash64("vector", F.lit(seed)), F.lit(1_000_000)) < int(round(training_share * 1_000_000))
    sample = usable if training_share >= 1.0 else usable.filter(kept)
    sample = sample.withColumn("vector", F.col("vector").cast("array<double>"))
    if n_cells == 1:
        points = sample.select(array_to_vector("vector").alias("features"))
        center = np.asarray(points.select(Summarizer.mean(F.col("features"))).first()[0].toArray(), dtype=np.float64)
        return center[None, :] / (np.linalg.norm(center) or 1.0)
    return kmeans.train(sample, n_cells, size, seed, max_iter)


def nearest_cells(
    df: DataFrame, centers: np.ndarray, nprobe: int, id_col: str, vector: str = "vector"
) -> DataFrame:
    """(id, cell) for the `nprobe` nearest cells of each vector; a map over the rows without a shuffle."""
    slim = df.select(F.col(id_col).alias("id"), F.col(vector).alias("vector"))
    sent = df.sparkSession.sparkContext.broadcast(centers)
    id_type = slim.schema["id"].dataType.simpleString()
    n = min(nprobe, len(centers))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, vectors = _unit_rows(batch.column("vector"))
            if rows.size == 0:
                continue
            distance = np.round(1.0 - vectors @ sent.value.T, 9)
            cells = np.argsort(distance, axis=1, kind="stable")[:, :n]
            ids = batch.column("id").take(pa.array(np.repeat(rows, n)))
            cell = pa.array(cells.reshape(-1).astype(np.int32))
            yield pa.RecordBatch.from_arrays([ids, cell], names=["id", "cell"])

    return slim.mapInArrow(assign, f"id {id_type}, cell int").withColumnRenamed("id", id_col)


def nearest_rounded(vectors: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """The cell of the smallest rounded distance, of equal ones the first.

    Products in single precision leave the cells within twice their largest possible error of the best one; only where
    several are left are distances computed in double precision.
    """
    dim, out = centers.shape[1], np.empty(len(vectors), np.int32)
    margin = 2.0 * ((dim + 4) * 2.0**-24 + 10.0**-DISTANCE_DIGITS)
    short, step = centers.astype(np.float32).T, max(1, SCORES_PER_STEP // len(centers))
    for start in range(0, len(vectors), step):
        block = vectors[start : start + step]
        rough = block.astype(np.float32) @ short
        row, cell = np.nonzero(rough >= (rough.max(axis=1) - np.float32(margin))[:, None])
        if row.size > rough.size // 16 and row.size > len(block):
            out[start : start + step] = np.argmin(np.round(1.0 - block @ centers.T, DISTANCE_DIGITS), axis=1)
            continue
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        out[start : start + step] = cell[starts]
        several = np.flatnonzero(np.bincount(row, minlength=len(block))[row] > 1)
        if several.size == 0:
            continue
        row, cell, distance = row[several], cell[several], np.empty(several.size)
        for at in range(0, several.size, max(1, NUMBERS_PER_STEP // dim)):
            part = slice(at, at + max(1, NUMBERS_PER_STEP // dim))
            distance[part] = np.round(1.0 - np.einsum("nd,nd->n", block[row[part]], centers[cell[part]]), DISTANCE_DIGITS)
        order = np.lexsort((cell, distance, row))
        first = order[np.flatnonzero(np.diff(row[order], prepend=-1))]
        out[start + row[first]] = cell[first]
    return out


def assign_cells(df: DataFrame, centers: np.ndarray, vector: str = "vector") -> DataFrame:
    """All columns plus the nearest cell; rows without a direction have no cell and drop out."""
    small_arrow_batches(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(centers)
    place = df.columns.index(vector)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, vectors = _unit_rows(batch.column(place))
            if rows.size == 0:
                continue
            cell = nearest_rounded(vectors, sent.value)
            kept = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(cell)], names=[*kept.schema.names, "cell"])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(assign, f"{columns}, cell int")


def write_cells(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Store the base by cell, so that a search only opens the folders of the probed cells.

    A cell is written by as many tasks as it fills files; a large cell is no single task and a small one no
    heap of tiny files. The rows are read twice, so they are stored first: their cells are found once.
    """
    with Intermediate(df.sparkSession) as steps:
        df = steps.stored(df, "cells")
        key = next(c for c in df.columns if c != "cell")
        files = df.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / rows_per_file).cast("bigint").alias("_files"))
        spread = df.join(F.broadcast(files), "cell").withColumn("_file", F.pmod(F.xxhash64(key), F.col("_files")))
        spread.repartition("cell", "_file").drop("_files", "_file").write.partitionBy("cell").parquet(path)


def ivf_topk(
    base: DataFrame,
    queries: DataFrame,
    centers: np.ndarray,
    k: int = SEARCH_K,
    nprobe: int = 8,
    item_id: str = "item_id",
    query_id: str = "query_id",
    vector: str = "vector",
    query_vector: str = "vector",
    **limits: int,
) -> DataFrame:
    """Top-k among the rows of each query's `nprobe` cells; with all cells probed it equals the exact search.

    `base` carries a `cell` column from `assign_cells` or `write_cells`.
    """
    probes = nearest_cells(queries, centers, nprobe, query_id, query_vector).withColumnRenamed(query_id, "query_id")
    return search(base, queries, k, item_id, query_id, vector, query_vector, probes=probes, **limits)[0]


def recall_against(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact neighbours that were found, per query."""
    return (
        exact.select("query_id", "item_id")
        .join(found.select("query_id", "item_id", F.lit(1).alias("hit")), ["query_id", "item_id"], "left")
        .groupBy("query_id")
        .agg(F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))
    )


def index_decision(
    counts: DataFrame,
    state: DataFrame,
    threshold_pct: float = GROWTH_THRESHOLD_PCT,
    min_rows: int = MIN_INDEX_ROWS,
) -> DataFrame:
    """CREATE, REBUILD, KEEP or SKIP per index from the present row count and the count at the last build.

    counts: (index_name, row_count) of usable vectors; state: (index_name, last_row_count), no row = never built.
    """
    growth = F.lit(100.0) * (F.col("row_count") - F.coalesce("last_row_count", F.lit(0)))
    growth = F.try_divide(growth, F.greatest(F.coalesce("last_row_count", F.lit(0)), F.lit(1)))
    return (
        counts.join(state.select("index_name", "last_row_count"), "index_name", "left")
        .withColumn("growth_pct", growth)
        .withColumn(
            "decision",
            F.when(F.col("row_count") < min_rows, "SKIP")
            .when(F.col("last_row_count").isNull(), "CREATE")
            .when(F.col("growth_pct") > threshold_pct, "REBUILD")
            .otherwise("KEEP"),
        )
    )


def index_state(decisions: DataFrame) -> DataFrame:
    """State to store after acting on the decisions: the count moves only when an index was (re)built."""
    built = F.col("decision").isin("CREATE", "REBUILD")
    return decisions.select(
        "index_name",
        F.when(built, F.col("row_count")).otherwise(F.col("last_row_count")).alias("last_row_count"),
    ).filter(F.col("last_row_count").isNotNull())


def index_health(counts: DataFrame, state: DataFrame) -> DataFrame:
    """(table_name, row_count, has_index) for every embedding table."""
    return counts.join(
        state.select("table_name", F.lit(True).alias("has_index")), "table_name", "left"
    ).select("table_name", "row_count", F.coalesce("has_index", F.lit(False)).alias("has_index"))


__all__ = [
    "assign_cells", "default_cells", "index_decision", "index_health", "index_state", "ivf_topk",
    "nearest_cells", "recall_against", "train_cells", "write_cells",
]

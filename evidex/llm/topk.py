"""Exact top-k by inner product of integer vectors.

Queries and base rows are packed into tiles (one matrix per row). A base shard belongs to one shard group, and every
query block is sent to every group, so the base is moved once. A task multiplies the tiles of its group, keeps the k
best per query while it goes from shard to shard, and hands on one list per query and group. The lists are merged in
two steps, first within sets of groups, then over all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidex.llm.common import arrow_schema, stored_table

QUERIES_PER_BLOCK = 2_048
ROWS_PER_SHARD = 8_192
SHARDS_PER_GROUP = 16
GROUPS_PER_MERGE = 64
EXACT = 2.0**53
LARGEST = 2**63 - 1

_TILE = arrow_schema(dim=pa.int32(), part=pa.int32(), seq=pa.int64(), ids=pa.binary(), cells=pa.binary())
_TILE_DDL = "dim int, part int, seq long, ids binary, cells binary"
_HITS = arrow_schema(query_id=pa.int64(), group=pa.int64(), vec_id=pa.int64(), score=pa.int64())


def usable(vector: str) -> Column:
    """Rows that take part: a vector without null, NaN or infinite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~bad


def _packed(vectors: DataFrame, rows: int, scale: float) -> DataFrame:
    """Rows of (id, v) as tiles of at most `rows` vectors of one length; cells are floor(scale * x) as doubles."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def tile(dim: int) -> pa.RecordBatch:
            nonlocal seq
            ids, cells = (np.concatenate(x) for x in zip(*held.pop(dim)))
            seq += 1
            row = [[dim], [part], [seq], [ids.tobytes()], [cells.tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(row, _TILE)], schema=_TILE)

        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                piece = batch.slice(at, rows)
                lengths = np.asarray(piece.column(1).value_lengths())
                ids = np.asarray(piece.column(0), dtype=np.int64)
                with np.errstate(over="ignore"):
                    flat = np.nan_to_num(np.floor(scale * np.asarray(piece.column(1).flatten(), dtype=np.float64)))
                ends = np.cumsum(lengths)
                for dim in np.unique(lengths):
                    own = np.flatnonzero(lengths == dim)
                    take = (ends[own] - dim)[:, None] + np.arange(dim)[None, :]
                    held.setdefault(int(dim), []).append((ids[own], flat[take].reshape(own.size, dim)))
                    if sum(x[0].size for x in held[int(dim)]) >= rows:
                        yield tile(int(dim))
        for dim in list(held):
            yield tile(dim)

    return vectors.mapInArrow(pack, _TILE_DDL)


def _whole(queries: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Inner products by integers of any length, held within +-(2^63 - 1)."""
    out = np.array([[int(x) for x in r] for r in queries], dtype=object) @ np.array([[int(x) for x in r] for r in base], dtype=object).T
    return np.array([[max(-LARGEST, min(LARGEST, x)) for x in r] for r in out], dtype=np.int64).reshape(out.shape)


def _products(queries: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Exact integer inner products, held within +-(2^63 - 1); only rows of large cells leave the matrix product."""
    dim = max(1, queries.shape[1])
    q_top, b_top = np.abs(queries).max(axis=1, initial=0), np.abs(base).max(axis=1, initial=0)
    with np.errstate(over="ignore"):
        plain = q_top.max(initial=0) * dim * b_top.max(initial=0) < EXACT
    if plain:
        return (queries @ base.T).astype(np.int64)
    border = np.sqrt(EXACT / dim) / 2
    q_large, b_large = q_top > border, b_top > border
    out = np.empty((len(queries), len(base)), np.int64)
    out[np.ix_(~q_large, ~b_large)] = (queries[~q_large] @ base[~b_large].T).astype(np.int64)
    if q_large.any():
        out[q_large] = _whole(queries[q_large], base)
    if b_large.any() and not q_large.all():
        out[np.ix_(~q_large, b_large)] = _whole(queries[~q_large], base[b_large])
    return out


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id, best first."""
    if scores.size > k:
        border = np.partition(scores, scores.size - k)[scores.size - k]
        near = np.flatnonzero(scores >= border)
    else:
        near = np.arange(scores.size)
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def _tile_scores(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, names, matrix, best = None, None, None, []

        def flush() -> pa.RecordBatch:
            sizes = [len(b[0]) for b in best]
            columns = [
                np.repeat(names, sizes), np.full(sum(sizes), now[0]),
                np.concatenate([b[0] for b in best]), np.concatenate([b[1] for b in best]),
            ]
            return pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns], schema=_HITS)

        for batch in batches:
            for row in batch.to_pylist():
                key = (row["group"], row["q_part"], row["q_seq"], row["dim"])
                if key != now:
                    if now is not None:
                        yield flush()
                    now, names = key, np.frombuffer(row["q_ids"], np.int64)
                    matrix = np.frombuffer(row["q_cells"], np.float64).reshape(names.size, row["dim"])
                    best = [(np.empty(0, np.int64), np.empty(0, np.int64))] * names.size
                ids = np.frombuffer(row["ids"], np.int64)
                base = np.frombuffer(row["cells"], np.float64).reshape(ids.size, row["dim"])
                for start in range(0, names.size, 256):
                    scores = _products(matrix[start : start + 256], base)
                    for i, line in enumerate(scores, start):
                        mine = ids != names[i]
                        at, who = (line, ids) if mine.all() else (line[mine], ids[mine])
                        pick = _best(at, who, k)
                        ids_now = np.concatenate([best[i][0], who[pick]])
                        scores_now = np.concatenate([best[i][1], at[pick]])
                        keep = _best(scores_now, ids_now, k)
                        best[i] = (ids_now[keep], scores_now[keep])
        if now is not None:
            yield flush()

    return run


def exact_topk(
    base: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", scale: float = 64.0
) -> DataFrame:
    """The k base rows with the highest inner product of floor(scale * x), for every row of `queries`.

    Returns query_id, rank (from 1), vec_id, score. A row is no candidate of a query with its own id. Ties go to the
    smaller id. A score beyond a bigint stands as its largest or smallest value (+-(2^63 - 1)), a cell beyond a double as
    the largest double; all others are exact. Vectors that are null or hold a null or non-finite component, and rows without an id, take no part;
    vectors of different lengths never meet. Repeated base rows are separate candidates; a repeated query id is
    answered once, by its smallest vector. Empty tables give no rows; other columns are ignored.
    """

    def clean(df: DataFrame) -> DataFrame:
        found = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
        return found.filter(F.col("id").isNotNull() & usable("v"))

    once = clean(queries).groupBy("id").agg(F.min("v").alias("v"))
    blocks = _packed(once, QUERIES_PER_BLOCK, scale).select(
        "dim", F.col("part").alias("q_part"), F.col("seq").alias("q_seq"), F.col("ids").alias("q_ids"), F.col("cells").alias("q_cells")
    )
    # Stored, so that both uses below see the same shards whatever happens to executors in between.
    shards = stored_table(_packed(clean(base), ROWS_PER_SHARD, scale), "shards")
    # A task of the scan gives its shards to groups in turn, so a group's size does not grow with the base.
    shards = shards.withColumn("group", F.col("part").cast("long") * 1_000_000 + F.floor((F.col("seq") - 1) / SHARDS_PER_GROUP))
    groups = shards.select("dim", "group").distinct()
    sent = blocks.join(groups, "dim")
    # Each query block is followed by all shards of the group, so its list runs on from tile to tile. In any other
    # order lists are only handed on earlier.
    tiles = sent.join(shards, ["dim", "group"]).select("dim", "group", "q_part", "q_seq", "q_ids", "q_cells", "ids", "cells")
    hits = tiles.mapInArrow(_tile_scores(k), "query_id long, group long, vec_id long, score long")

    order = [F.col("score").desc(), F.col("vec_id").asc()]
    some = Window.partitionBy("query_id", "set").orderBy(*order)
    merged = hits.withColumn("set", F.pmod(F.xxhash64("group"), F.lit(GROUPS_PER_MERGE)))
    merged = merged.withColumn("n", F.row_number().over(some)).filter(F.col("n") <= k)
    all_of = Window.partitionBy("query_id").orderBy(*order)
    ranked = merged.withColumn("rank", F.row_number().over(all_of)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

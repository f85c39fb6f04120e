"""Exact nearest neighbours by cosine distance.

The base table stays where it is: each task scores its own rows against the queries with one matrix
product per batch, and hands on only its k best rows per query. Those candidates are merged by a window.
No row pair is ever emitted. Few queries travel as a broadcast whose size is checked; many queries are stored,
and the tasks read them block by block. With cells, blocks of both sides meet in a shuffle by cell.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidex.functions.scalars import predicate
from evidex.operators.groups import topk_per_group
from evidex.session import estimated_splits, small_arrow_batches, stored

# Fixed values (defaults the results depend on).
SEARCH_K = 40
NEIGHBOR_K = 64
DISTANCE_DIGITS = 9

# Limits of what one broadcast or one block may hold.
BROADCAST_QUERIES = 4096
BROADCAST_BYTES = 256 * 1024 * 1024
BLOCK_BASE_ROWS = 16_384
BLOCK_QUERY_ROWS = 1_024
SCORES_PER_STEP = 4_000_000
NUMBERS_PER_STEP = 500_000
CANDIDATES_PER_TASK = 100_000
CANDIDATES = 1_000_000_000


def drop_empty_vectors(df: DataFrame, vector: str = "vector") -> DataFrame:
    return df.filter(F.col(vector).isNotNull() & (F.size(vector) > 0))


def _unit_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and unit vectors of a list column; rows without a direction are left out."""
    lengths = np.asarray(column.value_lengths().fill_null(0))
    rows = np.flatnonzero(lengths > 0)
    if rows.size == 0:
        return rows, np.empty((0, 0))
    dim = int(lengths[rows[0]])
    if not (lengths[rows] == dim).all():
        raise ValueError("vectors of different length in one search")
    flat = np.asarray(column.take(pa.array(rows)).flatten(), dtype=np.float64)
    matrix = flat.reshape(rows.size, dim)
    norms = np.sqrt((matrix * matrix).sum(axis=1))
    good = np.isfinite(norms) & (norms > 0)
    return rows[good], matrix[good] / norms[good, None]


def _steps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the vectors of one hold at most NUMBERS_PER_STEP numbers, or one row."""
    for batch in batches:
        widest = pc.max(batch.column("vector").value_lengths()).as_py() or 1
        rows = max(1, NUMBERS_PER_STEP // widest)
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


class TopK:
    """Running k best (distance, id) per query over any number of batches."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        self.best: list[tuple[np.ndarray, np.ndarray]] = [None] * len(queries)
        self.limit = np.full(len(queries), np.inf)

    def add(self, ids: pa.Array, vectors: np.ndarray, which: np.ndarray | None = None) -> None:
        """Score rows against all queries, or against the query numbers in `which`.

        Only the ids of rows that may still enter a query's k best are turned into Python values.
        """
        which = np.arange(len(self.queries)) if which is None else which
        if len(ids) == 0 or which.size == 0:
            return
        step = max(1, SCORES_PER_STEP // which.size)
        for start in range(0, len(ids), step):
            part = vectors[start : start + step]
            distance = np.round(1.0 - part @ self.queries[which].T, DISTANCE_DIGITS)
            limit = self.limit[which]
            if len(part) > self.k and np.isinf(limit).any():
                limit = np.minimum(limit, np.partition(distance, self.k - 1, axis=0)[self.k - 1])
            row, col = np.nonzero(distance <= limit[None, :])
            if row.size == 0:
                continue
            order = np.argsort(col, kind="stable")
            row, col = row[order], col[order]
            needed, at = np.unique(row, return_inverse=True)
            names = np.empty(needed.size, dtype=object)
            names[:] = ids.take(pa.array(start + needed)).to_pylist()
            cuts = np.flatnonzero(np.diff(col)) + 1
            for rows, cols, name in zip(np.split(row, cuts), np.split(col, cuts), np.split(at, cuts)):
                self._merge(which[cols[0]], distance[rows, cols[0]], names[name])

    def _merge(self, query: int, distance: np.ndarray, ids: np.ndarray) -> None:
        held = self.best[query]
        if held is not None:
            distance = np.concatenate([held[0], distance])
            ids = np.concatenate([held[1], ids])
        if distance.size > self.k:
            border = np.partition(distance, self.k - 1)[self.k - 1]
            near = distance <= border
            distance, ids = distance[near], ids[near]
        keep = np.lexsort((ids, distance))[: self.k]
        self.best[query] = (distance[keep], ids[keep])
        if keep.size == self.k:
            self.limit[query] = self.best[query][0][-1]

    def result(self, query_ids: np.ndarray, schema: pa.Schema) -> pa.RecordBatch | None:
        hits = [(q, d, i) for q, (d, i) in enumerate(x or ((), ()) for x in self.best) if len(d)]
        if not hits:
            return None
        columns = [
            np.repeat([query_ids[q] for q, _, _ in hits], [len(d) for _, d, _ in hits]),
            np.concatenate([i for _, _, i in hits]),
            np.concatenate([d for _, d, _ in hits]),
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(c.tolist(), type=f.type) for c, f in zip(columns, schema)], schema=schema
        )


_ARROW = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64()}


def _hit_schema(queries: DataFrame, query_id: str, base: DataFrame, item_id: str) -> tuple[str, pa.Schema]:
    types = [queries.schema[query_id].dataType.simpleString(), base.schema[item_id].dataType.simpleString()]
    unknown = set(types) - set(_ARROW)
    if unknown:
        raise TypeError(f"ids must be string, bigint or int, not {unknown}")
    ddl = f"query_id {types[0]}, item_id {types[1]}, distance double"
    arrow = pa.schema([("query_id", _ARROW[types[0]]), ("item_id", _ARROW[types[1]]), ("distance", pa.float64())])
    return ddl, arrow


def bounded_rows(df: DataFrame, limit: int) -> pa.Table | None:
    """The rows as an Arrow table if there are at most `limit`, else None; never fetches more than limit + 1."""
    table = df.limit(limit + 1).toArrow()
    return table if table.num_rows <= limit else None


def _one_array(table: pa.Table, name: str) -> pa.Array:
    column = table[name].combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def _fewer_tasks(base: DataFrame, candidates: int) -> DataFrame:
    """Let one task read several splits when each task would hand on many candidates.

    Merging partitions needs no shuffle; the cores stay busy with at least four tasks each.
    """
    tasks = max(4 * base.sparkSession.sparkContext.defaultParallelism, CANDIDATES // candidates)
    return base.coalesce(tasks) if estimated_splits(base) > tasks else base


def _scan_with_broadcast(base: DataFrame, held: pa.Table, probes: pa.Table | None, k: int, ddl: str, arrow: pa.Schema):
    rows, matrix = _unit_rows(_one_array(held, "vector"))
    query_ids = np.asarray(held["query_id"].to_pylist(), dtype=object)[rows]
    by_cell = None
    if probes is not None:
        number = {q: n for n, q in enumerate(query_ids)}
        by_cell = {}
        for q, cell in zip(probes["query_id"].to_pylist(), probes["cell"].to_pylist()):
            if q in number:
                by_cell.setdefault(cell, []).append(number[q])
        by_cell = {c: np.asarray(qs) for c, qs in by_cell.items()}
    sent = base.sparkSession.sparkContext.broadcast((query_ids, matrix, by_cell))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of_queries, query_matrix, cells = sent.value
        top = TopK(query_matrix, k)
        for batch in _steps(batches):
            rows, vectors = _unit_rows(batch.column("vector"))
            if rows.size == 0:
                continue
            ids = batch.column("item_id").take(pa.array(rows))
            if cells is None:
                top.add(ids, vectors)
                continue
            cell = np.asarray(batch.column("cell").take(pa.array(rows)))
            for c in np.unique(cell):
                if int(c) in cells:
                    inside = np.flatnonzero(cell == c)
                    top.add(ids.take(pa.array(inside)), vectors[inside], cells[int(c)])
        out = top.result(ids_of_queries, arrow)
        if out is not None:
            yield out

    return base.mapInArrow(search, ddl)


def _scan_with_stored(base: DataFrame, queries: DataFrame, k: int, ddl: str, arrow: pa.Schema, base_rows: int, query_rows: int) -> DataFrame:
    """Many queries: they are stored once, and each task reads them block by block for its own base rows.

    The base stays where it is. A task keeps one block of base rows, one of queries, and the k-th best distance that
    each query has seen in this task; only rows at most that far are handed on.
    """
    unique = stored(queries.select("query_id", F.col("vector").cast("array<double>").alias("vector")), "queries")
    path = unique.inputFiles()[0].rsplit("/", 1)[0] if unique.inputFiles() else None
    if path is None:
        return base.sparkSession.createDataFrame([], ddl)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = pafs.FileSystem.from_uri(path)
        files = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(folder)) if f.path.endswith(".parquet"))
        limits: dict[int, np.ndarray] = {}
        held: list[tuple[pa.Array, np.ndarray]] = []

        def meet() -> Iterator[pa.RecordBatch]:
            ids, vectors = pa.concat_arrays([i for i, _ in held]), np.concatenate([v for _, v in held])
            held.clear()
            blocks = pads.dataset(files, filesystem=fs, format="parquet").to_batches(batch_size=query_rows, use_threads=False)
            for number, block in enumerate(blocks):
                rows, matrix = _unit_rows(block.column("vector"))
                if rows.size == 0:
                    continue
                top = TopK(matrix, k)
                top.limit = limits.get(number, top.limit)
                top.add(ids, vectors)
                limits[number] = top.limit
                out = top.result(np.asarray(block.column("query_id").to_pylist(), dtype=object)[rows], arrow)
                if out is not None:
                    yield out

        size = 0
        for batch in _steps(batches):
            rows, vectors = _unit_rows(batch.column("vector"))
            for start in range(0, rows.size, base_rows):
                part = slice(start, start + base_rows)
                held.append((batch.column("item_id").take(pa.array(rows[part])), vectors[part]))
                size += held[-1][1].shape[0]
                if size >= base_rows:
                    yield from meet()
                    size = 0
        if held:
            yield from meet()

    return base.mapInArrow(search, ddl)


def _with_block_counts(base: DataFrame, queries: DataFrame, base_rows: int, query_rows: int) -> tuple[DataFrame, DataFrame]:
    """Add `base_blocks` and `query_blocks`: in how many blocks the rows of each side are cut in each cell."""
    # One row per cell; the number of cells is limited when the cells are trained.
    sizes = F.broadcast(
        base.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / base_rows).cast("bigint").alias("base_blocks")).join(
            queries.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / query_rows).cast("bigint").alias("query_blocks")),
            "cell",
        )
    )
    return base.join(sizes, "cell"), queries.join(sizes, "cell")


def _numbers_below(count: str):
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(count) - 1))


def _meet_in_blocks(
    base: DataFrame,
    queries: DataFrame,
    k: int,
    ddl: str,
    arrow: pa.Schema,
    base_rows: int,
    query_rows: int,
) -> DataFrame:
    """Blocks of base rows meet blocks of queries of the same cell; each meeting keeps its own k best."""
    base, queries = _with_block_counts(base, queries, base_rows, query_rows)
    base_side = (
        base.withColumn("base_block", F.pmod(F.xxhash64("item_id"), F.col("base_blocks")))
        .withColumn("query_block", _numbers_below("query_blocks"))
        .select("cell", "base_block", "query_block", "item_id", "vector")
    )
    query_side = (
        queries.withColumn("query_block", F.pmod(F.xxhash64("query_id"), F.col("query_blocks")))
        .withColumn("base_block", _numbers_below("base_blocks"))
        .select("cell", "base_block", "query_block", "query_id", "vector")
    )

    def meet(base_block: pa.Table, query_block: pa.Table) -> pa.Table:
        if base_block.num_rows == 0 or query_block.num_rows == 0:
            return arrow.empty_table()
        rows, matrix = _unit_rows(_one_array(query_block, "vector"))
        query_ids = np.asarray(query_block["query_id"].to_pylist(), dtype=object)[rows]
        items, vectors = _unit_rows(_one_array(base_block, "vector"))
        if rows.size == 0 or items.size == 0:
            return arrow.empty_table()
        top = TopK(matrix, k)
        top.add(_one_array(base_block, "item_id").take(pa.array(items)), vectors)
        out = top.result(query_ids, arrow)
        return arrow.empty_table() if out is None else pa.Table.from_batches([out])

    keys = ["cell", "base_block", "query_block"]
    return base_side.groupBy(*keys).cogroup(query_side.groupBy(*keys)).applyInArrow(meet, ddl)


def _repeats(queries: DataFrame, held: pa.Table | None) -> bool:
    if held is not None:
        return len(set(held["query_id"].to_pylist())) < held.num_rows
    return not queries.groupBy("query_id").count().filter("count > 1").isEmpty()


def search(
    base: DataFrame,
    queries: DataFrame,
    k: int,
    item_id: str,
    query_id: str,
    vector: str,
    query_vector: str,
    probes: DataFrame | None = None,
    max_broadcast: int = BROADCAST_QUERIES,
    block_base_rows: int = BLOCK_BASE_ROWS,
    block_query_rows: int = BLOCK_QUERY_ROWS,
) -> tuple[DataFrame, bool]:
    """(query_id, item_id, distance, rank) of the k nearest base rows per query, and whether the number of
    queries was found to be at most `max_broadcast` (the hits are then at most k times as many).

    With `probes` (query_id, cell) a query only meets base rows of its cells, and `base` has a `cell` column.
    """
    most = int(base.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if not 1 <= k <= most:
        raise ValueError(f"k must be from 1 to {most}, up to which Spark cuts lists before it shuffles them")
    small_arrow_batches(base.sparkSession)
    ddl, arrow = _hit_schema(queries, query_id, base, item_id)
    cell = [F.col("cell").cast("int").alias("cell")] if probes is not None else []
    slim = drop_empty_vectors(base.select(F.col(item_id).alias("item_id"), F.col(vector).alias("vector"), *cell))
    wanted = drop_empty_vectors(queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).alias("vector")))

    held = bounded_rows(wanted, max_broadcast)
    if held is not None and held.nbytes > BROADCAST_BYTES:
        held = None
    if _repeats(wanted, held):
        raise ValueError("a query id comes twice")
    pairs = None
    if held is not None and probes is not None:
        pairs = bounded_rows(probes.select("query_id", "cell"), max_broadcast * 1024)
        held = held if pairs is not None else None
    if held is not None and held.num_rows == 0:
        return slim.sparkSession.createDataFrame([], f"{ddl}, rank int"), True

    if held is not None:
        if pairs is not None:
            probed = sorted(set(pairs["cell"].to_pylist()))
            slim = slim.filter(F.col("cell").isin(probed))
        found = _scan_with_broadcast(_fewer_tasks(slim, held.num_rows * k), held, pairs, k, ddl, arrow)
    else:
        if probes is None:
            found = _scan_with_stored(slim, wanted, k, ddl, arrow, block_base_rows, block_query_rows)
        else:
            wanted = wanted.join(probes.select("query_id", F.col("cell").cast("int")), "query_id")
            found = _meet_in_blocks(slim, wanted, k, ddl, arrow, block_base_rows, block_query_rows)
    # Every task adds k candidates per query; beyond a few they are first cut down in parallel.
    salt = F.col("item_id") if k * estimated_splits(slim) > CANDIDATES_PER_TASK else None
    best = topk_per_group(found, ["query_id"], [F.col("distance"), F.col("item_id")], k, salt_by=salt)
    return best, held is not None


def vector_topk(
    base: DataFrame,
    queries: DataFrame,
    k: int = SEARCH_K,
    constraints: Iterable[tuple[str, str, object]] = (),
    prefilter: Iterable[tuple[str, str, object]] = (),
    item_id: str = "item_id",
    query_id: str = "query_id",
    vector: str = "vector",
    query_vector: str = "vector",
    **limits: int,
) -> DataFrame:
    """Exact top-k per query. `constraints` filter the k hits afterwards; `prefilter` narrows the base first.

    Constraints may name query_id, item_id, distance, rank or any other column of the base table.
    """
    base, constraints = base.filter(predicate(prefilter)), list(constraints)
    hits, few = search(base, queries, k, item_id, query_id, vector, query_vector, **limits)
    if not constraints:
        return hits
    own = {"query_id", "item_id", "distance", "rank"}
    extra = sorted({f for f, _, _ in constraints} - own - {"TRUE"})
    if extra:
        side = base.select(F.col(item_id).alias("item_id"), *extra)
        hits = side.join(F.broadcast(hits) if few else hits, "item_id")
    return hits.filter(predicate(constraints)).select("query_id", "item_id", "distance", "rank")


def mean_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, vector) with the mean vector of each key, from one partial sum per key and task."""
    mean = Summarizer.mean(array_to_vector(F.col(vector).cast("array<double>")))
    usable = drop_empty_vectors(df.select(key, vector), vector)
    return usable.groupBy(key).agg(mean.alias("mean")).select(key, vector_to_array("mean").alias("vector"))


__all__ = [
    "BROADCAST_QUERIES", "NEIGHBOR_K", "SEARCH_K", "TopK", "bounded_rows", "drop_empty_vectors",
    "mean_vectors", "search", "vector_topk",
]

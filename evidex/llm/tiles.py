"""Integer vectors packed into tiles: one row holds the ids and a matrix of many vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidex.llm.common import arrow_schema

_TILE = arrow_schema(dim=pa.int32(), part=pa.int32(), seq=pa.int64(), ids=pa.binary(), missing=pa.binary(), labels=pa.binary(), cells=pa.binary())
_TILE_DDL = "dim int, part int, seq long, ids binary, missing binary, labels binary, cells binary"


def usable(vector: str) -> Column:
    """Rows that take part: a vector that is not null, without null, NaN or infinite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~bad


def cells_of(blob: bytes, rows: int) -> np.ndarray:
    """The matrix of a tile, one row per vector."""
    cells = np.frombuffer(blob, np.int32)
    return cells.reshape(rows, cells.size // rows)


def packed(vectors: DataFrame, rows: int, scale: float, limit: Callable[[int], int]) -> DataFrame:
    """Rows of (id long, v array<double> of usable components, label long if there is one) as tiles of `rows` vectors of one length.

    A cell is floor(scale * x), held within +-`limit` of the vector's length and +-2^30. `part` and `seq` tell the tiles
    of a task apart; `missing` marks rows without an id.
    """
    labelled = "label" in vectors.columns

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        held: dict[int, list[tuple[np.ndarray, ...]]] = {}

        def tile(dim: int) -> pa.RecordBatch:
            nonlocal seq
            ids, missing, labels, cells = (np.concatenate(x) for x in zip(*held.pop(dim)))
            seq += 1
            row = [[dim], [part], [seq], [ids.tobytes()], [missing.tobytes()], [labels.tobytes()], [cells.tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(row, _TILE)], schema=_TILE)

        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                piece = batch.slice(at, rows)
                lengths = np.asarray(piece.column("v").value_lengths())
                missing = np.asarray(piece.column("id").is_null())
                ids = np.asarray(piece.column("id").fill_null(0), dtype=np.int64)
                labels = np.asarray(piece.column("label"), dtype=np.int64) if labelled else ids
                with np.errstate(over="ignore"):
                    flat = np.floor(scale * np.asarray(piece.column("v").flatten(), dtype=np.float64))
                ends = np.cumsum(lengths)
                for dim in map(int, np.unique(lengths)):
                    own = np.flatnonzero(lengths == dim)
                    take = (ends[own] - dim)[:, None] + np.arange(dim)[None, :]
                    most = min(limit(dim), 2**30)
                    cells = np.clip(flat[take], -most, most).astype(np.int32)
                    held.setdefault(dim, []).append((ids[own], missing[own], labels[own] if labelled else ids[:0], cells))
                    if sum(x[0].size for x in held[dim]) >= rows:
                        yield tile(dim)
        for dim in list(held):
            yield tile(dim)

    return vectors.mapInArrow(pack, _TILE_DDL)

"""Hard negatives by a secondary-sort shuffle.

Anchors and rows are multiplied tile by tile. A score travels as a packed key of (anchor, descending score, kind, id):
rows are dealt out by anchor and sorted by the whole key, so that a task sees an anchor's rows from the best to the
worst. A positive opens a window of scores, every later negative inside is handed on, and a window closes when it is
full or the scores have fallen below it. Nothing of an anchor is held but its open windows.

Two such passes are run. The first finds the positives. The second knows their windows, so a group of tiles hands on, for
each window, only its own best negatives; the others cannot be among the first of all.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidex.llm.common import arrow_schema, stored_table
from evidex.llm.tiles import cells_of, packed, usable

ANCHORS_PER_BLOCK = 1_024
ROWS_PER_SHARD = 8_192
SHARDS_PER_GROUP = 16
EXACT = 2**53

# Of equal scores positives come first, as a window may begin at its own positive's score.
POSITIVE, NEGATIVE = 0, 1

_KEY = np.dtype([("anchor", ">u8"), ("fall", ">u8"), ("kind", "u1"), ("id", ">u8")])
LAYOUT = ">QQBQ"
_HALF = 1 << 63
_KEYS = arrow_schema(key=pa.binary(), part=pa.int32(), seq=pa.int64(), dim=pa.int32())


def cell_limit(dim: int) -> int:
    """Cells are held within this size, so that a score fits into 64 bits."""
    return isqrt(2**62 // max(1, dim))


def pack_keys(anchors: np.ndarray, scores: np.ndarray, kind: int, ids: np.ndarray) -> np.ndarray:
    """Keys whose bytes sort like (anchor, score from high to low, kind, id)."""
    keys = np.empty(ids.size, _KEY)
    shift = np.uint64(_HALF)
    keys["anchor"], keys["id"] = anchors.astype(np.uint64) + shift, ids.astype(np.uint64) + shift
    keys["fall"] = ~(scores.astype(np.uint64) + shift)
    keys["kind"] = kind
    return keys


def unpack_key(key: bytes) -> tuple[int, int, int, int]:
    """anchor, score, kind, id of a key."""
    anchor, fall, kind, one = struct.unpack(LAYOUT, key)
    return anchor - _HALF, _HALF - 1 - fall, kind, one - _HALF


def _products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products: as doubles below 2^53, as 64-bit integers beyond."""
    bound = int(np.abs(anchors).max(initial=0)) * int(np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
    kind = np.float64 if bound < EXACT else np.int64
    return (anchors.astype(kind) @ rows.astype(kind).T).astype(np.int64)


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if scores.size > k:
        near = np.flatnonzero(scores >= np.partition(scores, scores.size - k)[scores.size - k])
    else:
        near = np.arange(scores.size)
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


class _Positives:
    """Keeps the best rows of each anchor's own label."""

    kind = POSITIVE

    def __init__(self, k: int):
        self.k = k

    def open(self, names: np.ndarray, labels: np.ndarray, windows) -> None:
        self.names, self.labels = names, labels

    def same(self, i: int, labels: np.ndarray) -> np.ndarray:
        return np.flatnonzero(labels == self.labels[i])

    def pick(self, i: int, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return _first(scores, ids, self.k)


class _Negatives(_Positives):
    """Keeps the best rows of other labels within each window of an anchor."""

    kind = NEGATIVE

    def open(self, names: np.ndarray, labels: np.ndarray, windows) -> None:
        super().open(names, labels, windows)
        self.windows: dict[int, set[tuple[int, int]]] = {}
        for w in windows:
            self.windows.setdefault(w["anchor"], set()).add((w["low"], w["high"]))

    def same(self, i: int, labels: np.ndarray) -> np.ndarray:
        return np.flatnonzero(labels != self.labels[i]) if int(self.names[i]) in self.windows else np.empty(0, np.int64)

    def pick(self, i: int, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
        found = []
        for low, high in self.windows.get(int(self.names[i]), ()):
            inside = np.flatnonzero((scores >= low) & (scores <= high))
            found.append(inside[_first(scores[inside], ids[inside], self.k)])
        return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)


def _scores(keeper: _Positives):
    """Candidates of every anchor of a block among the shards of a group, as packed keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, matrix = None, [], None

        def flush() -> pa.RecordBatch:
            sizes = [h[0].size for h in held]
            scores, ids = (np.concatenate([h[c] for h in held]) for c in (0, 1))
            keys = pack_keys(np.repeat(keeper.names, sizes), scores, keeper.kind, ids)
            raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(_KEY.itemsize), keys.size, [None, pa.py_buffer(keys.tobytes())])
            place = [pa.array(np.full(keys.size, now[c]), type=_KEYS.field(f).type) for c, f in ((1, "part"), (2, "seq"), (3, "dim"))]
            return pa.RecordBatch.from_arrays([raw.cast(pa.binary()), *place], schema=_KEYS)

        for batch in batches:
            for row in batch.to_pylist():
                key = (row["group"], row["a_part"], row["a_seq"], row["dim"])
                if key != now:
                    if now is not None:
                        yield flush()
                    now, names = key, np.frombuffer(row["a_ids"], np.int64)
                    keeper.open(names, np.frombuffer(row["a_labels"], np.int64), row.get("windows"))
                    matrix = cells_of(row["a_cells"], names.size)
                    held = [(np.empty(0, np.int64), np.empty(0, np.int64))] * names.size
                ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
                cells = cells_of(row["cells"], ids.size)
                allowed: dict[int, np.ndarray] = {}
                for start in range(0, names.size, 128):
                    block = _products(matrix[start : start + 128], cells)
                    for i, line in enumerate(block, start):
                        of = int(keeper.labels[i])
                        mine = allowed[of] if of in allowed else allowed.setdefault(of, keeper.same(i, labels))
                        mine = mine[ids[mine] != names[i]]
                        pick = mine[keeper.pick(i, line[mine], ids[mine])]
                        scores, who = np.concatenate([held[i][0], line[pick]]), np.concatenate([held[i][1], ids[pick]])
                        keep = keeper.pick(i, scores, who)
                        held[i] = (scores[keep], who[keep])
        if now is not None:
            yield flush()

    return run


def _by_anchor(keys: RDD, partitions: int) -> RDD:
    """Keyed records dealt out by anchor and sorted by their whole key."""
    return keys.repartitionAndSortWithinPartitions(partitions, lambda key: xxhash.xxh3_64_intdigest(key[:8]))


def _take_positives(k: int):
    """The first k rows of each anchor, from rows sorted by key."""

    def run(records) -> Iterator[tuple]:
        now, seen = None, 0
        for key, place in records:
            anchor, score, _, one = unpack_key(key)
            if anchor != now:
                now, seen = anchor, 0
            if seen < k:
                seen += 1
                yield (anchor, one, score, *place)

    return run


def open_windows(records, k: int, low: int, high: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(anchor, positive, rank, negative, positive score, negative score) from keys in order.

    A positive opens the window low * positive <= 100 * score <= high * positive; it closes after k negatives or when
    the scores have fallen below it.
    """
    now, opened = None, []
    for key, _ in records:
        anchor, score, kind, one = unpack_key(key)
        if anchor != now:
            now, opened = anchor, []
        if kind == POSITIVE:
            opened.append([one, score, 0])
            continue
        for window in opened:
            if low * window[1] <= 100 * score <= high * window[1]:
                window[2] += 1
                yield (anchor, window[0], window[2], one, window[1], score)
        opened = [w for w in opened if w[2] < k and 100 * score >= low * w[1]]


def mine_negatives(
    rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    scale: float = 256.0, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """Hard negatives of every anchor: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are inner products of floor(scale * x), ordered from high to low, ties by the smaller id. An anchor's
    positives are its first `positives` other rows of the same label; for each of them the first `negatives` rows of
    another label with low * positive_score <= 100 * negative_score <= high * positive_score are returned.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part; vectors of different
    lengths never meet. A row is no candidate of an anchor with its own id. Repeated rows are candidates of their own; a
    repeated anchor is answered once, for its smallest (label, vector). Empty tables give no rows. Finite components
    whose cell leaves +-sqrt(2^62 / length) (2.7e8 for 64 components) are held at it, so that scores fit into a bigint.
    Other columns are ignored.
    """
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def clean(df: DataFrame) -> DataFrame:
        found = df.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"))
        return found.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & usable("v"))

    once = clean(anchors).groupBy("id").agg(F.min(F.struct("label", "v")).alias("first")).select("id", "first.label", "first.v")
    blocks = stored_table(packed(once, ANCHORS_PER_BLOCK, scale, cell_limit), "anchors")
    blocks = blocks.select("dim", *(F.col(c).alias(f"a_{c}") for c in ("part", "seq", "ids", "labels", "cells")))
    shards = stored_table(packed(clean(rows), ROWS_PER_SHARD, scale, cell_limit), "shards")
    # A task of the scan gives its shards to groups in turn, so a group's size does not grow with the table.
    shards = shards.select("dim", "ids", "labels", "cells", (F.col("part").cast("long") * 1_000_000 + F.floor((F.col("seq") - 1) / SHARDS_PER_GROUP)).alias("group"))
    groups = shards.select("dim", "group").distinct()

    def candidates(sent: DataFrame, keeper: _Positives) -> DataFrame:
        # Each block is followed by all shards of the group, so its candidates run on from tile to tile.
        return sent.join(groups, "dim").join(shards, ["dim", "group"]).mapInArrow(_scores(keeper), "key binary, part int, seq long, dim int")

    own = candidates(blocks, _Positives(positives)).rdd.map(lambda r: (bytes(r[0]), tuple(r)[1:]))
    best = _by_anchor(own, n).mapPartitions(_take_positives(positives))
    found = stored_table(spark.createDataFrame(best, "anchor long, id long, score long, a_part int, a_seq long, dim int", verifySchema=False), "positives")

    # Ceiling and floor of the window's ends as whole numbers; decimals, as 100 times a score may leave 64 bits.
    score = F.col("score").cast("decimal(20,0)")
    ends = F.struct("anchor", F.ceil(score * low / 100).cast("long").alias("low"), F.floor(score * high / 100).cast("long").alias("high"))
    # A block has a bounded number of anchors and each a few positives, so the list of its windows is bounded too.
    windows = found.groupBy("dim", "a_part", "a_seq").agg(F.collect_list(ends).alias("windows"))
    others = candidates(blocks.join(windows, ["dim", "a_part", "a_seq"]).select(*blocks.columns, "windows"), _Negatives(negatives))
    keys = others.rdd.map(lambda r: (bytes(r[0]), None))
    leading = found.rdd.mapPartitions(_positive_keys)
    mined = _by_anchor(keys.union(leading), n).mapPartitions(lambda records: open_windows(records, negatives, low, high))
    return spark.createDataFrame(mined, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long", verifySchema=False)


def _positive_keys(rows) -> Iterator[tuple[bytes, None]]:
    for r in rows:
        yield struct.pack(LAYOUT, r["anchor"] + _HALF, _HALF - 1 - r["score"], POSITIVE, r["id"] + _HALF), None

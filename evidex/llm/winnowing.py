"""Document fingerprints by winnowing.

Every run of k code points has a rolling hash. Of every `window` consecutive hashes the smallest is chosen, of equal ones
the rightmost, and kept with its position. Two texts that share a run of at least window + k - 1 code points therefore
share a chosen hash inside it, and chosen positions are never more than `window` apart.

The rolling hash is a polynomial modulo 2^64 over code points. Runs are taken as differences of prefix sums and powers,
so that a text costs a few vector operations whatever k is. Windows compare the upper 32 bits of the hashes.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidex.llm.common import arrow_schema, mix64, small_batches

RUN = 20
WINDOW = 64
BATCH_BYTES = 8 << 20
BLOCK = 1 << 18

# The base of the polynomial is odd, so that it has an inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
LOW = np.uint64(0xFFFFFFFF)
HIGH = np.uint64(32)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Winnower:
    """Chosen hashes and their positions; powers are computed once for blocks of any text."""

    def __init__(self, run: int = RUN, window: int = WINDOW):
        if run < 1 or window < 1:
            raise ValueError("run and window must be at least 1")
        self.run, self.window = run, window
        longest = BLOCK + run + window
        self.down, self.up = _powers(INVERSE, longest), _powers(BASE, longest)

    def hashes(self, points: np.ndarray) -> np.ndarray:
        """The rolling hash of every run of code points."""
        n = points.size
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((points + np.uint64(1)) * self.down[:n], out=sums[1:])
        rolled = (sums[self.run :] - sums[: n + 1 - self.run]) * self.up[self.run - 1 : n]
        return mix64(rolled)

    def _chosen(self, hashes: np.ndarray, window: int) -> np.ndarray:
        """Positions of the smallest hash of each window, the rightmost of equal ones, in order and once each."""
        n = hashes.size
        # The position counts down from the right, so that the smallest of equal hashes is the rightmost.
        keys = (hashes & ~LOW) | np.arange(n - 1, -1, -1, dtype=np.uint64)
        width = 1
        while 2 * width <= window:
            keys = np.minimum(keys[:-width], keys[width:])
            width *= 2
        if width < window:
            step = window - width
            keys = np.minimum(keys[:-step], keys[step:])
        at = n - 1 - (keys & LOW).astype(np.int64)
        return at[np.flatnonzero(np.diff(at, prepend=-1))]

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Chosen hashes (64 bits) and the code point at which each run begins, in order.

        A text shorter than a run is one run; one with less than a window of runs is one window; an empty text has none.
        """
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        n = points.size
        if n == 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        if n < self.run:
            whole = int(np.bitwise_xor.reduce(mix64(points * np.uint64(BASE) + np.arange(n, dtype=np.uint64))))
            return mix64(np.array([whole + n & (1 << 64) - 1], np.uint64)), np.zeros(1, np.int64)
        found, places, last = [], [], -1
        # Blocks overlap by all but one hash of a window, so each window lies in exactly one of them.
        for start in range(0, max(1, n - self.run - self.window + 2), BLOCK):
            block = points[start : start + BLOCK + self.window + self.run - 2]
            hashes = self.hashes(block)
            at = self._chosen(hashes, min(self.window, hashes.size))
            at = at[at + start > last]
            found.append(hashes[at])
            places.append(at + start)
            last = int(places[-1][-1]) if at.size else last
        return np.concatenate(found), np.concatenate(places)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of distinct hashes that two fingerprints have in common; two empty ones are alike."""
    a, b = np.unique(a), np.unique(b)
    common = np.intersect1d(a, b, assume_unique=True).size
    either = a.size + b.size - common
    return common / either if either else 1.0


def as_text(hashes: np.ndarray, places: np.ndarray) -> str:
    """A fingerprint as hex: 16 digits of each hash and 8 of its position, in order."""
    entries = np.empty(hashes.size, [("hash", ">u8"), ("at", ">u4")])
    entries["hash"], entries["at"] = hashes, places
    return entries.tobytes().hex()


def from_text(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    entries = np.frombuffer(bytes.fromhex(fingerprint), [("hash", ">u8"), ("at", ">u4")])
    return entries["hash"].astype(np.uint64), entries["at"].astype(np.int64)


def fingerprints(docs: DataFrame, run: int = RUN, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row doc_id, n_chars (code points) and fingerprint: the chosen (hash, at) of its whole text, in order.

    A null text is empty and has an empty fingerprint. Equal texts have equal fingerprints. Every row is one result,
    repeated and null ids included; other columns are ignored; nothing is shuffled.
    """
    entry = pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int64())]))
    schema = arrow_schema(doc_id=pa.int64(), n_chars=pa.int64(), fingerprint=entry)

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winnower = Winnower(run, window)
        for batch in small_batches(batches, "text", BATCH_BYTES):
            names, sizes, parts = batch.column(0), [], []
            for value in batch.column(1):
                value = value.as_py() or ""
                sizes.append(len(value))
                parts.append(winnower.of(value))
            flat = [np.concatenate([p[c] for p in parts]) for c in (0, 1)]
            inner = pa.StructArray.from_arrays([pa.array(flat[0].view(np.int64)), pa.array(flat[1])], ["hash", "at"])
            ends = pa.array(np.cumsum([0, *(p[0].size for p in parts)]), type=pa.int32())
            lists = pa.ListArray.from_arrays(ends, inner)
            yield pa.RecordBatch.from_arrays([names, pa.array(sizes, type=pa.int64()), lists], schema=schema)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run_batches, "doc_id long, n_chars long, fingerprint array<struct<hash: long, at: long>>")


_EDITED = arrow_schema(
    doc_id=pa.int64(), n_chars=pa.int64(), edited_sha256=pa.string(), fingerprint=pa.string(), edited_fingerprint=pa.string(),
    near_edited=pa.float64(), near_next=pa.float64(),
)
_EDITED_DDL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


class _Document:
    """A text with its fingerprint, computed when it is first asked for."""

    def __init__(self, doc_id: int | None, text: str):
        self.doc_id, self.text = doc_id, text
        self.chosen: tuple[np.ndarray, np.ndarray] | None = None

    def fingerprint(self, winnower: Winnower, like: _Document | None = None) -> tuple[np.ndarray, np.ndarray]:
        if self.chosen is None:
            same = like is not None and like.chosen is not None and like.text == self.text
            self.chosen = like.chosen if same else winnower.of(self.text)
        return self.chosen


def _against_next(winnower: Winnower, now: _Document, following: _Document) -> tuple:
    """The result of a document whose next one has come."""
    n = len(now.text)
    cut = n // 3
    edited = now.text[: n - cut] + following.text[:cut]
    own = now.fingerprint(winnower)
    other = following.fingerprint(winnower, now)
    changed = own if edited == now.text else winnower.of(edited)
    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return now.doc_id, n, sha, as_text(*own), as_text(*changed), likeness(own[0], changed[0]), likeness(own[0], other[0])


def _edit_parts(run: int, window: int):
    """Documents in descending order, each part followed by the first document of the next part."""

    def rows(batches: Iterator[pa.RecordBatch], winnower: Winnower) -> Iterator[tuple]:
        part, now = None, None
        for batch in small_batches(batches, "text", BATCH_BYTES):
            for at, end, name, value in zip(*(batch.column(c) for c in ("part", "end", "doc_id", "text"))):
                at, following = at.as_py(), _Document(name.as_py(), value.as_py())
                if at == part and now is not None:
                    yield _against_next(winnower, now, following)
                # What follows an end in the same part are copies of it, which have no result here.
                part, now = at, None if end.as_py() else following

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*held), _EDITED)], schema=_EDITED)

        for row in rows(batches, Winnower(run, window)):
            held.append(row)
            size += 200 + len(row[3]) + len(row[4])
            if size > BATCH_BYTES:
                yield batch()
                held, size = [], 0
        if held:
            yield batch()

    return run_batches


def compare_edits(docs: DataFrame, run: int = RUN, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, in which the last third is replaced by the next text's beginning.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (see `as_text`), near_edited, near_next (shares of
    common hashes). The last floor(n_chars / 3) code points become the first as many (or all) of the next document in
    descending doc_id; after the last comes the first, and a single document is its own next.

    A null text is empty. Rows without an id come last. Rows that share an id are ordered by a hash of their texts and
    then by the texts, so that repeated rows follow each other. Empty tables give no rows; other columns are ignored.

    Each part of the order goes to one task together with a copy of the next part's first document. The parts are cut at
    the first keys of a range-partitioned pass over ids and hashes; one key per part comes back to the driver. A task
    holds two texts at a time. Rows of one id are cut by their texts' hashes; copies of one id and one text stay in one
    task, which computes their fingerprint once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("hash"), "text")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = rows.select("doc_id", "hash").repartitionByRange(n, F.col("doc_id").desc_nulls_last(), F.col("hash").desc())
    heads = keys.groupBy(F.spark_partition_id()).agg(F.max(F.struct("doc_id", "hash")).alias("head")).select("head.*").collect()
    # Ascending keys of what is a descending order, nulls below all ids.
    starts = sorted((h["doc_id"] is not None, h["doc_id"] or 0, h["hash"]) for h in heads)
    parts = max(1, len(starts))

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def parts_of(ids, hashes):
        import pandas as pd

        out = []
        for one, h in zip(ids.array, hashes):
            key = (not pd.isna(one), 0 if pd.isna(one) else int(one), h)
            at = bisect_left(starts, key)
            mine = parts - 1 - at
            # The first document of a part is also the end of the part before it, which is the last for the first.
            out.append([mine, -1 - (mine - 1) % parts] if at < parts and starts[at] == key else [mine])
        return pd.Series(out)

    # A null id would turn a column of ids into doubles, so it travels as its own flag.
    placed = rows.withColumn("place", F.explode(parts_of(F.col("doc_id").cast("string"), "hash")))
    end = F.col("place") < 0
    placed = placed.select(F.when(end, -1 - F.col("place")).otherwise(F.col("place")).alias("part"), end.alias("end"), "doc_id", "hash", "text")
    ordered = placed.repartitionById(parts, "part").sortWithinPartitions("part", "end", F.col("doc_id").desc_nulls_last(), F.col("hash").desc(), "text")
    return ordered.select("part", "end", "doc_id", "text").mapInArrow(_edit_parts(run, window), _EDITED_DDL)

"""Words, files and stored tables shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidex.session import shared_folder

# What separates words.
BLANKS = " \t\n\x0b\x0c\r"


def spaced(text: Column) -> Column:
    """The text with every blank character as one space; a null text becomes empty."""
    out = F.coalesce(text, F.lit(""))
    for c in BLANKS[1:]:
        out = F.replace(out, F.lit(c), F.lit(" "))
    return out


def words(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text as an array."""
    return F.array_remove(F.split(spaced(text), " "), "")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_bytes(text: str | None) -> list[bytes]:
    """The same words in Python: bytes.split() takes exactly these six characters as blanks."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def small_batches(batches: Iterable[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one holds about `limit` bytes of a string or binary column, or one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = batch.column(batch.schema.get_field_index(text))
        lengths = pc.binary_length(sizes).fill_null(0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, n in enumerate(lengths):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        yield batch.slice(start)


def stored_table(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the cluster's shared folder and read it back: it is computed once and outlives executors."""
    path = shared_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered_table(df: DataFrame, columns: list[str], label: str, row: str = "row") -> DataFrame:
    """Columns of a table of files with `row`: the number of the file and the place in it, however tasks cut the files.

    What is more than files as they are, or no files at all, is stored first.
    """
    place = F.col("_metadata.row_index")
    try:
        files = df if df._jdf.queryExecution().analyzed().children().isEmpty() else stored_table(df.select(*columns), label)
        files.select(place)
    except AnalysisException:
        files = stored_table(df.select(*columns), label)
    # One row per file, of which the driver has a list anyway.
    names = files.select(F.col("_metadata.file_path").alias("_file")).distinct()
    numbers = names.select("_file", (F.row_number().over(Window.orderBy("_file")) - 1).cast("long").alias("_number"))
    at = files.select(*columns, F.col("_metadata.file_path").alias("_file"), place.alias("_place"))
    return at.join(F.broadcast(numbers), "_file").select(*columns, (F.shiftleft("_number", 33) + F.col("_place")).alias(row))


class Scratch:
    """Stored tables that are only needed until a result is stored; `drop` removes their folders."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def table(self, df: DataFrame, label: str) -> DataFrame:
        path = shared_folder(self.spark, label)
        self.paths.append(path)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        for path in self.paths:
            p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
        self.paths.clear()


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store and the path inside it; any store that Arrow knows, local paths included."""
    return pafs.FileSystem.from_uri(uri)


class CommittedFile:
    """A file written under a temporary name and moved to its own name when it is complete.

    A task that is run again writes the same bytes to the same name; one that dies leaves only a temporary file,
    which no manifest names.
    """

    def __init__(self, folder: str, name: str):
        self.fs, base = file_system(folder)
        self.name, self.path = name, f"{base}/{name}"
        self.fs.create_dir(base, recursive=True)
        self.temporary = f"{base}/_{name}.{uuid.uuid4().hex}.tmp"
        self.out = self.fs.open_output_stream(self.temporary, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def commit(self) -> None:
        self.out.close()
        self.fs.move(self.temporary, self.path)


def as_batches(rows: Iterable[tuple], schema: pa.Schema, rows_per_batch: int = 2000) -> Iterator[pa.RecordBatch]:
    """Python rows as Arrow batches."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= rows_per_batch:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def arrow_schema(**types: pa.DataType) -> pa.Schema:
    return pa.schema(list(types.items()))


RowFunction = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def kept_in_worker(key: tuple, make: Callable[[], object]) -> object:
    """An object that is made once per Python worker and outlives its tasks, such as a loaded vocabulary.

    The modules of this package travel with each task, so it is kept in a module of the worker itself.
    """
    store = sys.modules.setdefault("evidex_worker_store", types.ModuleType("evidex_worker_store")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


# Words of up to so many bytes are hashed together, eight bytes at a time; masks keep the first 0 to 8 of them.
SHORT_WORD = 32
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class WordHashes:
    """64-bit hashes of words, equal for equal words in every task."""

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words of the texts one after another, and the number of words of each text."""
        # Blanks before and behind, so that each word has two edges and eight bytes can be read from any of its bytes.
        data = b" ".join([b"", *texts, b" " * 8])
        raw = np.frombuffer(data, np.uint8)
        blank = (raw == 32) | (raw - np.uint8(9) < 5)
        edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        starts, sizes = edges[::2], edges[1::2] - edges[::2]
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        counts = np.diff(np.searchsorted(starts, ends), prepend=0)
        eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
        found = mix64(sizes.astype(np.uint64))
        for k in range(0, SHORT_WORD, 8):
            left = np.flatnonzero(sizes > k) if k else slice(None)
            part = eight[starts[left] + k] & _FIRST_BYTES[np.minimum(sizes[left] - k, 8)]
            found[left] = mix64(found[left] ^ part)
        for i in np.flatnonzero(sizes > SHORT_WORD).tolist():
            found[i] = xxhash.xxh3_64_intdigest(data[starts[i] : starts[i] + sizes[i]])
        return found, counts


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sequence_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of `length` consecutive words; runs are not kept inside texts."""
    n = words.size - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, length, np.uint64)
    for k in range(length):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n])
    return out

"""Objects of a folder as a data source of Spark: `spark.read.format("objects")`, `readStream` and `write`.

A partition is a folder below the prefix, or a share of a large one by the hash of its names, so that listing and reading
are spread over tasks. Objects are read whole, a few at a time. Stores are those that Arrow knows, local paths included.

    register_objects(spark)
    files = spark.read.format("objects").option("content", "true").load("s3://bucket/prefix")
"""

from __future__ import annotations

import fnmatch
import mimetypes
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage,
)

from evidex.functions.scalars import as_column
from evidex.operators.chunks import SCREEN_SUFFIX, extract_chunks, html_text

OBJECT_SCHEMA = "object_uri string, media_type string, length bigint, modified timestamp, content binary"
OBJECT_INPUT = "name string, content binary"
BATCH_BYTES = 32 << 20
SPLITS = 4

# How long a file must have been there before a stream takes it, as files of one moment may still be coming.
SETTLE_SECONDS = 1.0

_ARROW = pa.schema([
    ("object_uri", pa.string()), ("media_type", pa.string()), ("length", pa.int64()), ("modified", pa.timestamp("us", tz="UTC")), ("content", pa.binary()),
])


def media_type_of(uri: str) -> str:
    return mimetypes.guess_type(uri)[0] or "application/octet-stream"


@dataclass
class _Place(InputPartition):
    """The files of a folder, of all below it, or of a share of them; of a stream those modified after one time and up to another."""

    folder: str
    recursive: bool
    share: int = 0
    shares: int = 1
    after: str | None = None
    until: str | None = None


class _Folder:
    """The store and the files below a prefix, with what the options ask for."""

    def __init__(self, options: dict[str, str]):
        self.prefix = options["path"].rstrip("/")
        self.pattern = options.get("pattern", "*")
        self.content = options.get("content", "false").lower() == "true"
        self.splits = int(options.get("splits", SPLITS if self.content else 1))
        self.settle = float(options.get("settleSeconds", SETTLE_SECONDS))

    def open(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(self.prefix)

    def uri(self, base: str, path: str) -> str:
        return self.prefix + path[len(base) :]

    def places(self, **times: str) -> list[_Place]:
        """One for the prefix's own files and some for each folder right below it."""
        fs, base = self.open()
        found = fs.get_file_info(pafs.FileSelector(base, allow_not_found=True))
        shares = [(s, self.splits) for s in range(self.splits)]
        out = [_Place(base, False, s, n, **times) for s, n in shares]
        return out + [_Place(f.path, True, s, n, **times) for f in found if f.type == pafs.FileType.Directory for s, n in shares]

    def files(self, fs: pafs.FileSystem, place: _Place) -> Iterator[pafs.FileInfo]:
        """Names that begin with a dot or underscore are of writers at work, and are no objects."""
        for info in fs.get_file_info(pafs.FileSelector(place.folder, recursive=place.recursive, allow_not_found=True)):
            if info.type != pafs.FileType.File or info.base_name[:1] in "._" or not fnmatch.fnmatch(info.base_name, self.pattern):
                continue
            modified = info.mtime.astimezone(UTC).isoformat(timespec="microseconds")
            if (place.after and modified <= place.after) or (place.until and modified > place.until):
                continue
            if zlib.crc32(info.path.encode()) % place.shares == place.share:
                yield info

    def read(self, place: _Place) -> Iterator[pa.RecordBatch]:
        fs, base = self.open()
        held: list[tuple] = []
        size = 0
        for info in self.files(fs, place):
            body = None
            if self.content:
                with fs.open_input_file(info.path) as f:
                    body = f.read()
            held.append((self.uri(base, info.path), media_type_of(info.path), info.size, info.mtime.astimezone(UTC), body))
            size += 200 + (info.size if self.content else 0)
            if size > BATCH_BYTES:
                yield _batch(held)
                held, size = [], 0
        if held:
            yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


class _Reader(DataSourceReader):
    def __init__(self, folder: _Folder):
        self.folder = folder

    def partitions(self) -> list[InputPartition]:
        return self.folder.places()

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        yield from self.folder.read(partition)


class _StreamReader(DataSourceStreamReader):
    """Files by the time of their last change: each trigger takes those after the last one's newest that have settled."""

    def __init__(self, folder: _Folder):
        self.folder = folder

    def initialOffset(self) -> dict:
        return {"until": ""}

    def latestOffset(self) -> dict:
        border = datetime.now(UTC) - timedelta(seconds=self.folder.settle)
        return {"until": border.isoformat(timespec="microseconds")}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return self.folder.places(after=start["until"], until=end["until"])

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        yield from self.folder.read(partition)

    def commit(self, end: dict) -> None:
        pass


@dataclass
class _Written(WriterCommitMessage):
    names: list[tuple[str, str]]


class _Writer(DataSourceWriter):
    """One object per row. Tasks write temporary names; the commit gives the objects their own, an aborted job leaves none."""

    def __init__(self, folder: _Folder):
        self.folder = folder

    def write(self, iterator: Iterable) -> _Written:
        fs, base = self.folder.open()
        names, made = [], set()
        for row in iterator:
            if row["name"] is None:
                continue
            path = f"{base}/{row['name'].lstrip('/')}"
            folder, _, last = path.rpartition("/")
            if folder not in made:
                fs.create_dir(folder, recursive=True)
                made.add(folder)
            temporary = f"{folder}/_{last}.{uuid.uuid4().hex}"
            with fs.open_output_stream(temporary, compression=None) as out:
                out.write(bytes(row["content"] or b""))
            names.append((temporary, path))
        return _Written(names)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, _ = self.folder.open()
        for message in messages:
            for temporary, path in message.names if message else ():
                fs.move(temporary, path)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, _ = self.folder.open()
        for message in messages:
            for temporary, _ in message.names if message else ():
                fs.delete_file(temporary)


class ObjectSource(DataSource):
    """Format `objects`. Options: path, pattern (of names), content (true reads the objects), splits (tasks per folder)."""

    @classmethod
    def name(cls) -> str:
        return "objects"

    def schema(self) -> str:
        return OBJECT_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(_Folder(dict(self.options)))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(_Folder(dict(self.options)))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("objects are only added")
        return _Writer(_Folder(dict(self.options)))


def register_objects(spark: SparkSession) -> None:
    spark.dataSource.register(ObjectSource)


def fetch_contents(uris: DataFrame) -> DataFrame:
    """The rows of `uris` (object_uri, ...) with `content` and `error`: an object that cannot be read has a null and the reason."""
    place = uris.columns.index("object_uri")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in uris.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, bodies, errors, size = 0, [], [], 0
            for i, uri in enumerate(batch.column(place).to_pylist()):
                try:
                    fs, path = pafs.FileSystem.from_uri(uri)
                    with fs.open_input_file(path) as f:
                        bodies.append(f.read())
                    errors.append(None)
                except Exception as e:
                    bodies.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
                size += len(bodies[-1] or b"")
                if size > BATCH_BYTES or i == batch.num_rows - 1:
                    columns = [*batch.slice(start, len(bodies)).columns, pa.array(bodies, pa.binary()), pa.array(errors, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "content", "error"])
                    start, bodies, errors, size = i + 1, [], [], 0

    return uris.mapInArrow(run, f"{kept}, content binary, error string")


def all_objects(spark: SparkSession, prefix: str, registered: DataFrame | None = None, pattern: str = "*") -> DataFrame:
    """(object_uri, media_type): the files below a prefix and the registered URIs, each once."""
    listed = spark.read.format("objects").option("pattern", pattern).load(prefix).select("object_uri", "media_type")
    if registered is None:
        return listed
    extra = registered.select("object_uri", "media_type").filter("object_uri is not null").dropDuplicates(["object_uri"])
    return listed.unionByName(extra.join(listed.select("object_uri"), "object_uri", "left_anti"))


def object_text(content: Column | str = "content", media_type: Column | str = "media_type") -> Column:
    """The text of an object: markup loses its tags, other text is taken as it is, anything else has none.

    Bytes that are no UTF-8 become replacement characters.
    """
    text, kind = F.make_valid_utf8(as_column(content).cast("string")), as_column(media_type)
    return F.when(kind.isin("text/html", "application/xhtml+xml"), html_text(text)).when(kind.startswith("text/"), text)


def folder_chunks(
    spark: SparkSession, prefix: str, registered: DataFrame | None = None, pattern: str = "*", suffix: str = SCREEN_SUFFIX
) -> Callable[[DataFrame], DataFrame]:
    """Chunks of the objects whose chunk is not stored yet, for `refresh`: the contents of the others are not read."""

    def make(done: DataFrame) -> DataFrame:
        found = all_objects(spark, prefix, registered, pattern)
        return extract_chunks(found, suffix, text=object_text(), extractor=fetch_contents, done=done)

    return make


__all__ = [
    "ObjectSource", "all_objects", "fetch_contents", "folder_chunks", "media_type_of", "object_text", "register_objects",
]

"""Deterministic sharded WARC archives.

Records are sorted by range of their key; each task writes its range as a chain of files that roll by compressed size,
every record its own gzip member without a time stamp. Headers and digests are made anew from the content. A file is
written under a temporary name and moved when complete; only files named by the manifest, itself a table that Spark
commits, belong to the archive. Tasks that are run again write the same bytes under the same names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidex.llm.common import CommittedFile, arrow_schema, as_batches, file_system, stored_table
from evidex.session import shared_folder

ROLL_BYTES = 64 * 1024 * 1024
MIN_REVISIT = 100
LEVEL = 4
RECORD_DATE = "2020-01-01T00:00:00Z"

_MANIFEST = arrow_schema(file=pa.string(), seq=pa.int64(), n_records=pa.int64(), n_bytes=pa.int64(), sha256=pa.string())
_MANIFEST_DDL = "file string, seq long, n_records long, n_bytes long, sha256 string"
_READ = arrow_schema(
    key=pa.int64(), url=pa.string(), payload_bytes=pa.int64(), payload_digest=pa.string(), record_type=pa.string(), refers_to=pa.int64(), payload=pa.binary()
)
_READ_DDL = "key long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def mark_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Add payload (bytes), digest and refers_to to rows of key, url, body.

    Among equal payloads of at least `min_bytes` the smallest key is the response that the others refer to.
    """
    rows = pages.withColumn("payload", F.coalesce(F.col("body"), F.lit("")).cast("binary")).drop("body")
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    # Partial minima: a payload on a third of the rows sends one row per task.
    first = rows.filter(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n"))
    # Stored, so that its true size decides how it is joined: pages move for it only when repeats are many.
    first = stored_table(first.filter("n > 1").select(F.col("digest").alias("d"), "first"), "repeats")
    joined = rows.join(first, (rows["digest"] == first["d"]) & (F.octet_length("payload") >= min_bytes), "left")
    refers = F.when(~F.col("key").eqNullSafe(F.col("first")), F.col("first"))
    return joined.withColumn("refers_to", refers).drop("d", "first")


def _clean(value: str | None) -> str:
    return "".join(c if c >= " " else " " for c in value or "").strip()


def _record_id(key: int | None) -> str:
    return f"<urn:record:{'none' if key is None else key}>"


def _record(key: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record: WARC headers, an HTTP header block, and the payload unless it is a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(key)}",
        f"WARC-Date: {RECORD_DATE}",
        f"WARC-Target-URI: {_clean(url)}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_record_id(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    """A gzip member without a time stamp: the same bytes for the same record."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _info(part: int) -> bytes:
    fields = f"software: evidex\r\nformat: WARC File Format 1.1\r\npart: {part}\r\n".encode()
    head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:file:{part}>\r\nWARC-Date: {RECORD_DATE}\r\n"
    return f"{head}Content-Type: application/warc-fields\r\nContent-Length: {len(fields)}\r\n\r\n".encode() + fields + b"\r\n\r\n"


def write_warc(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write rows of key, url, payload, digest, refers_to as archives below `folder`; returns the manifest table.

    The manifest has file, seq (order of the files by key), n_records, n_bytes and the sha256 of each file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, roll, out, records, hashed = TaskContext.get().partitionId(), 0, None, 0, None
        rows = []

        def close() -> None:
            nonlocal out
            out.commit()
            rows.append((out.name, part * 1_000_000 + roll, records, out.size, hashed.hexdigest()))
            out = None

        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(n)) for n in ("key", "url", "payload", "digest", "refers_to")]
            for values in zip(*columns):
                if out is not None and out.size >= roll_bytes:
                    close()
                    roll += 1
                if out is None:
                    out, records, hashed = CommittedFile(folder, f"part-{part:06d}-{roll:05d}.warc.gz"), 0, hashlib.sha256()
                    data = _member(_info(part))
                    out.write(data)
                    hashed.update(data)
                data = _member(_record(*[v.as_py() for v in values]))
                out.write(data)
                hashed.update(data)
                records += 1
        if out is not None:
            close()
        yield from as_batches(rows, _MANIFEST)

    order = ["key", "digest", "url"]
    manifest = pages.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, _MANIFEST_DDL)
    return stored_table(manifest, "warc-manifest")


def _members(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """The decompressed gzip members of a file, one at a time."""
    unpack, parts, data = zlib.decompressobj(31), [], b""
    while True:
        data = data or stream.read(size)
        if not data:
            break
        parts.append(unpack.decompress(data))
        data = b""
        if unpack.eof:
            yield b"".join(parts)
            data, unpack, parts = unpack.unused_data, zlib.decompressobj(31), []


def _parse(record: bytes) -> tuple | None:
    """A response or revisit as a row; the payload's size and digest are those of the full payload."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    if fields["WARC-Type"] == "warcinfo":
        return None
    block = rest[: int(fields["Content-Length"])]
    if "sha256:" + hashlib.sha256(block).hexdigest() != fields["WARC-Block-Digest"]:
        raise ValueError(f"block digest of {fields['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    whole = fields["WARC-Type"] == "response"
    if whole and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']}")

    def key(name: str) -> int | None:
        text = fields.get(name, "").removeprefix("<urn:record:").removesuffix(">")
        return int(text) if text not in ("", "none") else None

    return key("WARC-Record-ID"), fields["WARC-Target-URI"], length, digest, fields["WARC-Type"], key("WARC-Refers-To"), payload if whole else None


def read_warc(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of the files that a manifest names, a file to a task; digests are checked on the way.

    Returns key, url, payload_bytes, payload_digest, record_type, refers_to, payload (null for a revisit).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    records = (_parse(m) for m in _members(stream))
                    yield from as_batches((r for r in records if r is not None), _READ, 200)

    # A file to a task: the rows are too few for Spark to spread them by itself.
    files = manifest.select("file").repartition(max(1, manifest.count()))
    return files.mapInArrow(run, _READ_DDL)


def archive(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", body: str = "html", roll_bytes: int = ROLL_BYTES, folder: str | None = None
) -> tuple[DataFrame, DataFrame, str]:
    """Write one record per page and read the archives back: (records, manifest, folder).

    A null or empty body is an empty payload, a null url an empty target. Equal payloads of at least 100 bytes are
    stored once; the others are revisits of the smallest page id. A null page id sorts first, has the record id `none`
    and never is a response that others refer to; a row that repeats both the smallest id and its payload is a
    response too. Control characters in urls become spaces in the header. An empty table gives an empty manifest.
    Other columns are ignored. Without a folder a fresh one in the cluster's shared folder is taken.
    """
    spark: SparkSession = pages.sparkSession
    folder = folder or shared_folder(spark, "warc")
    rows = pages.select(F.col(page_id).cast("long").alias("key"), F.col(url).alias("url"), F.col(body).alias("body"))
    manifest = write_warc(mark_revisits(rows), folder, roll_bytes)
    return read_warc(manifest, folder), manifest, folder

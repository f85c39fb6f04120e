"""Token ids as binary files: one concatenated id array and Elias-Fano coded document boundaries per shard.

Documents are sorted by range of their id; each task encodes its range and writes shards that roll by size. A shard
holds, in one file: the ids, 2 bytes each while the vocabulary allows, else 4; the ends of its documents and their
ids, both as Elias-Fano sequences with a sample of the set bits, from which a document's offset is selected without any
table of 64-bit offsets. A manifest table that Spark commits names the files and counts their ids; the position of a
shard in the whole array is a running sum over it, one row per file.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidex.llm.common import CommittedFile, arrow_schema, as_batches, file_system, kept_in_worker, small_batches, stored_table
from evidex.session import shared_folder

ROLL_IDS = 16 * 1024 * 1024
SELECT_EVERY = 64
BATCH_BYTES = 1 << 20
CACHED_WORDS = 400_000
CACHED_PIECES = 600_000
MAGIC = b"EFTOKEN1"

_MANIFEST = arrow_schema(file=pa.string(), seq=pa.int64(), n_docs=pa.int64(), n_ids=pa.int64(), n_bytes=pa.int64())
_MANIFEST_DDL = "file string, seq long, n_docs long, n_ids long, n_bytes long"
_DOCS = arrow_schema(doc_id=pa.int64(), start=pa.int64(), n_tokens=pa.int64(), ids=pa.binary())
_DOCS_DDL = "doc_id long, start long, n_tokens long, ids binary"


class EliasFano:
    """A non-decreasing sequence of n integers below u in about n * (2 + log2(u / n)) bits.

    The low bits of each value are packed side by side; the high bits are a bit array in which value i sets bit
    high + i. `select` finds a value from the nearest sampled set bit.
    """

    def __init__(self, n: int, low_bits: int, base: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits, self.base = n, low_bits, base
        self.low, self.high = np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8)
        self.samples = np.frombuffer(samples, np.uint32)

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        base = int(values[0]) if values.size else 0
        v = (values - base).astype(np.uint64) if values.size else np.empty(0, np.uint64)
        n, top = v.size, int(v[-1]) if v.size else 0
        low_bits = max(0, ((top + 1) // n).bit_length() - 1) if n else 0
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((v[:, None] >> shifts[None, :]) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        at = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(at[-1]) + 1 if n else 0, np.uint8)
        high[at] = 1
        return cls(n, low_bits, base, low.tobytes(), np.packbits(high, bitorder="little").tobytes(), at[::SELECT_EVERY].astype(np.uint32).tobytes())

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        last = first + self.low_bits
        word = int.from_bytes(self.low[first // 8 : (last + 7) // 8].tobytes(), "little")
        return (word >> (first % 8)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """Value i: from the sampled bit before it, count set bits onwards."""
        at, left = int(self.samples[i // SELECT_EVERY]), i % SELECT_EVERY
        byte, word = at // 8, int(self.high[at // 8]) >> (at % 8) << (at % 8)
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        position = byte * 8 + (word & -word).bit_length() - 1
        return self.base + ((position - i) << self.low_bits) + self._low(i)

    def values(self) -> np.ndarray:
        """All values in order."""
        at = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        high = (at - np.arange(self.n)).astype(np.int64) << self.low_bits
        bits = np.unpackbits(self.low, count=self.n * self.low_bits, bitorder="little").reshape(self.n, self.low_bits).astype(np.int64)
        return self.base + high + (bits << np.arange(self.low_bits)).sum(axis=1, dtype=np.int64)

    def parts(self) -> tuple[dict, list[bytes]]:
        data = [self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()]
        return {"n": self.n, "low_bits": self.low_bits, "base": self.base, "sizes": [len(d) for d in data]}, data


def shard_parts(ids: list[bytes], width: int, ends: np.ndarray, doc_ids: np.ndarray) -> list[bytes]:
    """A whole shard in pieces: magic, length of the header, header (JSON), both sequences, ids.

    Documents without an id come first; the header counts them.
    """
    head, data = {"width": width, "nameless": ends.size - doc_ids.size}, []
    for name, one in (("ends", EliasFano.of(ends)), ("docs", EliasFano.of(doc_ids))):
        head[name], parts = one.parts()
        data += parts
    text = json.dumps(head).encode()
    return [MAGIC, len(text).to_bytes(4, "little"), text, *data, *ids]


def open_shard(data: bytes) -> tuple[EliasFano, EliasFano, int, np.ndarray]:
    """(ends, doc ids, documents without an id before them, ids) of a shard."""
    if data[:8] != MAGIC:
        raise ValueError("not a token shard")
    size = int.from_bytes(data[8:12], "little")
    head, at, found = json.loads(data[12 : 12 + size]), 12 + size, []
    for name in ("ends", "docs"):
        parts = []
        for n in head[name]["sizes"]:
            parts.append(data[at : at + n])
            at += n
        found.append(EliasFano(head[name]["n"], head[name]["low_bits"], head[name]["base"], *parts))
    return found[0], found[1], head["nameless"], np.frombuffer(data, f"<u{head['width']}", offset=at)


class WordEncoder:
    """Ids of texts, word by word, for a tokenizer that lower-cases, splits letters from signs and drops white space.

    Words repeat, so each is looked up once and kept. A word of Latin letters before other signs is two pre-tokens, which
    go to the tokenizer's model as they are, each once; any other word goes through the whole tokenizer. Stores are
    emptied when they are full.
    """

    # No apostrophe, which may begin a pre-token of letters.
    PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-&(-/:-@\[-`{-~]*)")

    def __init__(self, path: str, width: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.to_bytes = self.tokenizer.model, ByteLevel(add_prefix_space=False, use_regex=False)
        self.kind = "<%d" + {2: "H", 4: "I"}[width]
        self.known: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _ids(self, ids: list[int]) -> bytes:
        return struct.pack(self.kind % len(ids), *ids)

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            letters = piece if piece.isascii() else self.to_bytes.pre_tokenize_str(piece)[0][0]
            found = self.pieces[piece] = self._ids([t.id for t in self.model.tokenize(letters)])
        return found

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        plain = self.PLAIN.fullmatch(text)
        if plain is None or not (text.isascii() or ("\u0130" not in text and unicodedata.is_normalized("NFC", text))):
            return self._ids(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return self._piece(plain[1].lower()) + (self._piece(plain[2]) if plain[2] else b"")

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        # At blanks that the tokenizer drops too; split() of bytes knows no others.
        split = [(t or b"").split() for t in texts]
        needed = {w for ws in split for w in ws}
        new = [w for w in needed if w not in self.known]
        if len(self.known) + len(new) > CACHED_WORDS:
            self.known.clear()
            new = list(needed)
        if len(self.pieces) > CACHED_PIECES:
            self.pieces.clear()
        for w in new:
            self.known[w] = self._word(w)
        known = self.known.__getitem__
        return [b"".join(map(known, ws)) for ws in split]


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, width: int = 2, roll_ids: int = ROLL_IDS) -> DataFrame:
    """Encode doc_id, text in ascending doc_id order into shards below `folder`; returns the manifest table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, roll, rows = TaskContext.get().partitionId(), 0, []
        encoder = kept_in_worker(("words", tokenizer_path, width), lambda: WordEncoder(tokenizer_path, width))
        end = int(end_id).to_bytes(width, "little")
        ids, ends, names, total = [], [], [], 0

        def close() -> None:
            nonlocal roll, total
            out = CommittedFile(folder, f"part-{part:06d}-{roll:05d}.tok")
            for data in shard_parts(ids, width, np.array(ends, np.int64), np.array(names, np.int64)):
                out.write(data)
            out.commit()
            rows.append((out.name, part * 1_000_000 + roll, len(ends), total, out.size))
            roll, total = roll + 1, 0
            for held in (ids, ends, names):
                held.clear()

        for batch in small_batches(batches, "text", BATCH_BYTES):
            for name, data in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).cast(pa.binary()).to_pylist())):
                if total >= roll_ids:
                    close()
                ids.append(data + end)
                total += len(data) // width + 1
                ends.append(total)
                if name is not None:
                    names.append(name)
        if ends:
            close()
        yield from as_batches(rows, _MANIFEST)

    # Rows that repeat an id are put in order by a hash, so that a range may end among them; equal ones in any order.
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"), F.monotonically_increasing_id().alias("row"))
    keys = [F.col("doc_id").asc_nulls_first(), "text_key", "row"]
    ordered = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    return stored_table(ordered.mapInArrow(run, _MANIFEST_DDL), "token-manifest")


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """Documents of the shards: doc_id, start (ids of all documents before it), n_tokens, ids (as stored)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        for batch in batches:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    ends, names, nameless, ids = open_shard(stream.read())

                def rows():
                    start = 0
                    for end, doc in zip(ends.values().tolist(), [None] * nameless + names.values().tolist()):
                        yield doc, first + start, end - start, ids[start:end].tobytes()
                        start = end

                yield from as_batches(rows(), _DOCS, 500)

    # One row per file, in the order of the array.
    before = Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    files = stored_table(manifest.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first")), "token-files")
    # A file to a task: the rows are too few for Spark to spread them by itself.
    return files.repartition(max(1, files.count())).mapInArrow(run, _DOCS_DDL)


def crc_of_ids(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32: unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    schema = arrow_schema(doc_id=pa.int64(), start=pa.int64(), n_tokens=pa.int64(), ids_crc32=pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [zlib.crc32(np.frombuffer(b.as_buffer(), f"<u{width}").astype("<u4")) for b in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.int64())], schema=schema)

    return docs.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 2, width: int = 2, doc_id: str = "doc_id", text: str = "text", folder: str | None = None):
    """Write all documents as token shards and read them back: (documents, manifest, folder).

    A null or empty text is the end id alone. Documents are in ascending order of id, rows without an id
    first; rows that repeat an id (or have none) are in the order of a hash of their text. An empty table gives no files. `width` is 2 for vocabularies below 65,536 ids, else 4. Other columns are ignored.
    """
    folder = folder or shared_folder(docs.sparkSession, "tokens")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    manifest = write_tokens(rows, folder, tokenizer_path, end_id, width)
    return read_tokens(manifest, folder), manifest, folder

"""Byte-level BPE by a global shuffle of distinct pre-tokens.

Texts are split into pre-tokens where they lie. A block of texts keeps, for each text, the numbers of its pre-tokens
by position in a file of the shared folder, and sends each distinct pre-token once to the slot of its hash. There each
distinct pre-token of the whole corpus is encoded once; its ids go back to every block that asked, and the block puts
the ids of its texts together by position. A frequent pre-token is sent once per block, however often it occurs.
Decoding joins ids with the table of token bytes, which has one row per id of the vocabulary.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidex.llm.common import CommittedFile, arrow_schema, as_batches, file_system, small_batches, stored_table
from evidex.session import shared_folder

BLOCK_BYTES = 16 * 1024 * 1024
BATCH_BYTES = 1 << 20
IDS_PER_BATCH = 2_000_000

_WORDS = arrow_schema(block=pa.string(), slot=pa.int32(), data=pa.binary())
_WORDS_DDL = "block string, slot int, data binary"
_IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file: lines of base64 and id."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _planes(values: np.ndarray) -> bytes:
    """Unsigned 32-bit integers by byte position: equal high bytes lie side by side for the packer."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8, 4 * n).reshape(4, n).T.copy().view("<u4").ravel()


def _pack(*arrays: np.ndarray, tail: bytes = b"") -> bytes:
    head = np.array([len(arrays), *[a.size for a in arrays]], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(b"".join([head, *[_planes(a) for a in arrays], tail]))


def _unpack(data: bytes) -> tuple[list[np.ndarray], bytes]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    count = int.from_bytes(raw[:4], "little")
    at, out = 4 + 4 * count, []
    for n in np.frombuffer(raw, "<u4", count, 4).tolist():
        out.append(_from_planes(raw[at : at + 4 * n], n))
        at += 4 * n
    return out, raw[at:]


class PreTokens:
    """Numbers of the pre-tokens of one block, in order of first sight.

    A space before a character that is no white space always begins a pre-token, so texts are cut there first and each
    distinct piece meets the pattern once. Texts with other runs of white space go through the pattern whole.
    """

    def __init__(self, pattern: str):
        self.pattern, self.uneven = regex.compile(pattern), regex.compile(r" (?:\s|$)")
        self.number: dict[str, int] = {}
        self.pieces: dict[str, bytes] = {}

    def _learn(self, piece: str) -> None:
        found = [self.number.setdefault(w, len(self.number)) for w in self.pattern.findall(piece)]
        self.pieces[piece] = np.array(found, "<u4").tobytes()

    def sequence(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.uneven.search(text):
            cut = self.pattern.findall(text)
        else:
            first, *rest = text.split(" ")
            cut = [first, *[" " + p for p in rest]]
        for piece in set(cut):
            if piece not in self.pieces:
                self._learn(piece)
        return b"".join(map(self.pieces.__getitem__, cut))


def _split_blocks(folder: str, pattern: str, slots: int, block_bytes: int):
    """Texts to (block, slot, distinct pre-tokens); sequences go to one file per block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[int | None] = []
        sequences: list[bytes] = []
        held, words = 0, PreTokens(pattern)

        def close() -> Iterator[tuple]:
            block = f"{uuid.uuid4().hex}.seq"
            tokens = [w.encode("utf-8", "surrogatepass") for w in words.number]
            slot = np.fromiter((xxhash.xxh3_64_intdigest(t) % slots for t in tokens), np.uint32, len(tokens))
            out = CommittedFile(folder, block)
            ids = np.array([-1 if n is None else n for n in names], "<i8")
            known = np.array([n is not None for n in names], np.uint32)
            lengths = np.array([len(s) // 4 for s in sequences], np.uint32)
            out.write(_pack(slot, known, lengths, np.frombuffer(b"".join(sequences), "<u4"), tail=ids.tobytes()))
            out.commit()
            # A block without pre-tokens still has its row.
            for s in np.union1d(np.unique(slot), [0]).tolist():
                mine = [tokens[i] for i in np.flatnonzero(slot == s)]
                yield block, int(s), _pack(np.array([len(t) for t in mine], np.uint32), tail=b"".join(mine))

        for batch in small_batches(batches, "text", BATCH_BYTES):
            texts = batch.column(1).to_pylist()
            names += batch.column(0).to_pylist()
            sequences += map(words.sequence, texts)
            held += batch.column(1).nbytes
            if held >= block_bytes:
                yield from as_batches(close(), _WORDS, 50)
                names, sequences, held, words = [], [], 0, PreTokens(pattern)
        if names:
            yield from as_batches(close(), _WORDS, 50)

    return run


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple]:
    """Rows of sorted batches by runs of equal key."""
    rows = (row for batch in batches for row in batch.to_pylist())
    return groupby(rows, key=lambda r: r[key])


def _cut(lengths: np.ndarray, data: bytes) -> list[bytes]:
    ends = np.cumsum(lengths, dtype=np.int64)
    return [data[e - n : e] for e, n in zip(ends.tolist(), lengths.tolist())]


def _encode_slots(ranks_path: str, pattern: str):
    """Each distinct pre-token of a slot is encoded once; every block gets the ids of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(ranks_path), special_tokens={})

        def rows() -> Iterator[tuple]:
            for slot, group in _runs(batches, "slot"):
                known: dict[bytes, list[int]] = {}
                for row in group:
                    (lengths,), tail = _unpack(row["data"])
                    tokens = _cut(lengths, tail)
                    new = [t for t in tokens if t not in known]
                    known.update(zip(new, coder.encode_ordinary_batch([t.decode("utf-8", "surrogatepass") for t in new], num_threads=1)))
                    found = [known[t] for t in tokens]
                    counts = np.array([len(f) for f in found], np.uint32)
                    yield row["block"], slot, _pack(counts, np.array([i for f in found for i in f], np.uint32))

        yield from as_batches(rows(), _WORDS, 50)

    return run


def _gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of runs [start, start + length) one after another."""
    ends = np.cumsum(lengths, dtype=np.int64)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if ends.size else 0)


def _join_blocks(folder: str):
    """The ids of each text of a block, put together by position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        for block, group in _runs(batches, "block"):
            with fs.open_input_stream(f"{base}/{block}", compression=None) as stream:
                (slot, known, lengths, sequence), tail = _unpack(stream.read())
            counts, starts = np.zeros(slot.size, np.int64), np.zeros(slot.size, np.int64)
            pool, at = [], 0
            for row in group:
                (own, ids), _ = _unpack(row["data"])
                mine = np.flatnonzero(slot == row["slot"])
                counts[mine] = own
                starts[mine] = at + np.cumsum(own, dtype=np.int64) - own
                pool.append(ids.astype(np.int32))
                at += ids.size
            ids = np.concatenate(pool)
            names = np.frombuffer(tail, "<i8")
            ends = np.cumsum(lengths, dtype=np.int64)
            doc, n_docs = 0, lengths.size
            while doc < n_docs:
                first = int(ends[doc] - lengths[doc])
                last = max(doc + 1, int(np.searchsorted(ends, first + IDS_PER_BATCH // 2)))
                part = sequence[first : int(ends[last - 1])]
                flat = ids[_gather(starts[part], counts[part])]
                cut = np.concatenate([[0], np.cumsum(counts[part])])[np.concatenate([[first], ends[doc:last]]) - first]
                lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(flat, pa.int32()))
                keys = pa.array(names[doc:last], pa.int64(), mask=known[doc:last] == 0)
                yield pa.RecordBatch.from_arrays([keys, lists], schema=_IDS)
                doc = last

    return run


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", slots: int | None = None, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The ids of every text by the ranks, each match of the pattern by itself: doc_id, ids (array<int>).

    A null or empty text has no ids. Rows are encoded one by one, so repeated and null ids and repeated texts keep their
    rows. An empty table gives no rows. Other columns are ignored. `slots` is the number of groups that the distinct
    pre-tokens are dealt into, by default the number of shuffle partitions.
    """
    spark = docs.sparkSession
    slots = slots or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = shared_folder(spark, "sequences")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    asked = stored_table(rows.mapInArrow(_split_blocks(folder, pattern, slots, block_bytes), _WORDS_DDL), "pre-tokens")
    answered = asked.repartition(slots, "slot").sortWithinPartitions("slot").mapInArrow(_encode_slots(ranks_path, pattern), _WORDS_DDL)
    # As many tasks as slots: a block's file is much larger than the rows that ask for it.
    back = answered.repartition(slots, "block").sortWithinPartitions("block", "slot")
    return back.mapInArrow(_join_blocks(folder), "doc_id long, ids array<int>")


def decode(ids: DataFrame, ranks_path: str, doc_id: str = "doc_id", column: str = "ids") -> DataFrame:
    """The bytes behind each row's ids: doc_id, ids, decoded (binary).

    Ids meet the table of token bytes in the task; the table is as long as the vocabulary. No ids give empty bytes, null
    ids null. An id outside the table is an error.
    """
    schema = pa.schema([*_IDS, ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(ranks_path)
        table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        sizes = np.array([len(t) for t in table], np.int64)
        starts, pool = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(table), np.uint8)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                lists = part.column(1)
                flat = np.asarray(lists.flatten(), dtype=np.int64)
                lengths = np.asarray(lists.value_lengths().fill_null(0), dtype=np.int64)
                data = pool[_gather(starts[flat], sizes[flat])].tobytes()
                ends = np.concatenate([[0], np.cumsum(sizes[flat])])[np.concatenate([[0], np.cumsum(lengths)])]
                null = np.asarray(lists.is_null())
                texts = [None if n else data[a:b] for a, b, n in zip(ends[:-1].tolist(), ends[1:].tolist(), null.tolist())]
                yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(texts, pa.binary())], schema=schema)

    rows = ids.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(column).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")

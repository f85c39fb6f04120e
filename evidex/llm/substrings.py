"""Removal of repeated passages by prefix-partitioned suffix trees.

Every word of a text with enough words after it starts a suffix. Suffixes are dealt into groups by a prefix of 1, 2, 4 or
8 words: a first pass counts all prefixes, and those that begin too many suffixes for one task's memory are extended by
more words. Suffixes that share a long passage share every prefix, so a group holds whole subtrees. Inside a group
the suffixes are put in the order of their first `window` words, as hashes of that path: two leaves with the same path
hang below one internal node of at least that depth, and the passage repeats. Consecutive repeated windows of a text
are the maximal repeats.

A block of texts sends each distinct window once to a group, however often it occurs in the block, so that a passage in
a third of all texts stays small; blocks keep their texts in a file of the shared folder until the answers come back.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidex.llm.common import CommittedFile, WordHashes, arrow_schema, as_batches, file_system, mix64, small_batches, stored_table
from evidex.session import shared_folder, small_arrow_batches

WINDOW = 35
PREFIXES = (1, 2, 4, 8)
SLOTS = 4096
GROUP_WINDOWS = 4_000_000
BLOCK_BYTES = 8 * 1024 * 1024
BATCH_BYTES = 2 << 20
STEP_BYTES = 1 << 19
ALWAYS = -1

_COUNTS = arrow_schema(level=pa.int32(), slot=pa.int32(), n=pa.int64())
_PARTS = arrow_schema(block=pa.string(), group=pa.int32(), n=pa.int32(), data=pa.binary())
_PARTS_DDL = "block string, group int, n int, data binary"
_OUT = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())]


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a run from the hashes of its two parts, cut to the shorter array."""
    n = min(a.size, b.size)
    return mix64(a[:n] * np.uint64(0x9E3779B97F4A7C15) + mix64(b[:n] + np.uint64(0x632BE59BD9B4E019)))


def run_hashes(words: np.ndarray, length: int) -> dict[int, np.ndarray]:
    """Hashes of all runs of 1, 2, 4, ... words and of `length` words, by start; doubled step by step."""
    runs, size = {1: mix64(words)}, 1
    while 2 * size <= length:
        runs[2 * size] = _joined(runs[size], runs[size][size:])
        size *= 2
    whole, done = runs[size], size
    for part in sorted(runs, reverse=True):
        if done + part <= length:
            whole, done = _joined(whole, runs[part][done:]), done + part
    return {**runs, length: whole}


def window_starts(counts: np.ndarray, window: int) -> np.ndarray:
    """Positions in the words of all texts where a window of one text starts."""
    ends = np.cumsum(counts)
    starts, sizes = (ends - counts)[counts >= window], counts[counts >= window] - window + 1
    total = np.cumsum(sizes)
    return np.repeat(starts - (total - sizes), sizes) + np.arange(total[-1] if total.size else 0)


def _levels(window: int) -> list[int]:
    return [p for p in PREFIXES if p <= window]


def _slots(runs: dict[int, np.ndarray], starts: np.ndarray, level: int) -> np.ndarray:
    return (runs[level][starts] >> np.uint64(40)).astype(np.int64) % SLOTS


def _count_prefixes(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, levels = WordHashes(), _levels(window)
        found = np.zeros((len(levels), SLOTS), np.int64)
        for batch in small_batches(batches, "text", BATCH_BYTES):
            flat, counts = hashes.of([t or b"" for t in batch.column(0).cast(pa.binary()).to_pylist()])
            runs, starts = run_hashes(flat, max(levels)), window_starts(counts, window)
            for i, level in enumerate(levels):
                found[i] += np.bincount(_slots(runs, starts, level), minlength=SLOTS)
        level, slot = np.nonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(level, pa.int32()), pa.array(slot, pa.int32()), pa.array(found[level, slot], pa.int64())], schema=_COUNTS)

    return run


def plan_groups(counts: list[tuple[int, int, int]], window: int, most: int) -> tuple[np.ndarray, int]:
    """Group of each (level, slot), -1 where a prefix must be extended, and the number of groups.

    The table has a fixed size. Light slots share a group; a slot that is too large even at the last level is a group
    of its own.
    """
    levels = len(_levels(window))
    table, group, held = np.full((levels, SLOTS), -1, np.int32), 0, 0
    size = np.zeros((levels, SLOTS), np.int64)
    for level, slot, n in counts:
        size[level, slot] = n
    for level in range(levels):
        last = level == levels - 1
        for slot in range(SLOTS):
            n = int(size[level, slot])
            if n > most and not last:
                continue
            if held and held + n > most:
                group, held = group + 1, 0
            table[level, slot], held = group, held + n
        # The next level's prefixes are counted over all suffixes; groups begin anew.
        if held:
            group, held = group + 1, 0
        if not (table[level] < 0).any():
            break
    return table, max(group, 1)


def _text_steps(texts: list[bytes], limit: int) -> Iterator[list[bytes]]:
    """Runs of texts of at most `limit` bytes, or one text."""
    start = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield texts[start:i]
            start, held = i, 0
        held += len(text)
    if texts:
        yield texts[start:]


def _windows(texts: list[bytes], hashes: WordHashes, table: np.ndarray, window: int):
    """(words per text, window starts, group and path of each distinct window, its number for each start).

    No window spans two texts, so words and the hashes of their runs are held for a few texts at a time.
    """
    counts, starts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    groups, paths, before = [np.empty(0, np.int32)], [np.empty(0, np.uint64)], 0
    for some in _text_steps(texts, STEP_BYTES):
        flat, words = hashes.of(some)
        runs, at = run_hashes(flat, window), window_starts(words, window)
        own = np.full(at.size, -1, np.int32)
        for i, level in enumerate(_levels(window)):
            left = np.flatnonzero(own < 0)
            if not left.size:
                break
            own[left] = table[i][_slots(runs, at[left], level)]
        counts.append(words)
        starts.append(at + before)
        groups.append(own)
        if at.size:
            paths.append(runs[window][at])
        before += flat.size
    group, path = np.concatenate(groups), np.concatenate(paths)
    order = np.argsort(path)
    # Numbers of 16 bits are put in order by counting, not by comparing.
    narrow = group.astype(np.int16) if table.max() < 1 << 15 else group
    order = order[np.argsort(narrow[order], kind="stable")]
    g, p = group[order], path[order]
    first = np.ones(order.size, bool)
    first[1:] = (g[1:] != g[:-1]) | (p[1:] != p[:-1])
    number = np.empty(order.size, np.int64)
    number[order] = np.cumsum(first) - 1
    return np.concatenate(counts), np.concatenate(starts), g[first], p[first], number


def _pack_paths(paths: np.ndarray, often: np.ndarray) -> bytes:
    """Sorted paths as differences by byte position, and a bit for each that repeats in its block."""
    steps = np.diff(paths, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(steps + np.packbits(often).tobytes())


def _unpack_paths(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    steps = np.frombuffer(raw, np.uint8, 8 * n).reshape(8, n).T.copy().view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64), np.unpackbits(np.frombuffer(raw, np.uint8, offset=8 * n), count=n).astype(bool)


def _texts(parts: list[pa.RecordBatch]) -> list[bytes]:
    return [t or b"" for rows in parts for t in rows.column(1).cast(pa.binary()).to_pylist()]


def _send_windows(folder: str, table: np.ndarray, window: int, block_bytes: int):
    """Each block's distinct windows by group; its texts go to a file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        hashes = WordHashes()
        parts: list[pa.RecordBatch] = []
        part, seq, held = TaskContext.get().partitionId(), 0, 0

        def close() -> Iterator[tuple]:
            nonlocal seq
            # A task that is run again, for lost shuffle files too, makes the same blocks under the same names.
            block = f"{part:06d}-{seq:06d}.txt"
            seq += 1
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, parts[0].schema) as out:
                for rows in parts:
                    out.write_batch(rows)
            file = CommittedFile(folder, block)
            file.write(zstandard.ZstdCompressor(level=3).compress(sink.getvalue()))
            file.commit()
            del sink
            texts = _texts(parts)
            _, _, group, path, number = _windows(texts, hashes, table, window)
            often = np.bincount(number, minlength=group.size) > 1
            cuts = np.flatnonzero(np.diff(group)) + 1
            # Every block has a row, also one without windows.
            yield block, ALWAYS, 0, b""
            for g, p, o in zip(np.split(group, cuts), np.split(path, cuts), np.split(often, cuts)):
                if g.size:
                    yield block, int(g[0]), g.size, _pack_paths(p, o)

        for batch in small_batches(batches, "text", BATCH_BYTES):
            parts.append(batch)
            held += batch.column(1).nbytes
            if held >= block_bytes:
                yield from as_batches(close(), _PARTS, 20)
                parts, held = [], 0
        if parts:
            yield from as_batches(close(), _PARTS, 20)

    return run


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple]:
    rows = (row for batch in batches for row in batch.to_pylist())
    return groupby(rows, key=lambda r: r[key])


def _find_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which windows of a group's blocks hang below a deep internal node: a bit for each, in the order they came."""

    def rows() -> Iterator[tuple]:
        for group, members in _runs(batches, "group"):
            blocks, sizes, paths, often = [], [], [], []
            for row in members:
                if group == ALWAYS:
                    yield row["block"], group, 0, b""
                    continue
                p, o = _unpack_paths(row["data"], row["n"])
                blocks.append(row["block"])
                sizes.append(p.size)
                paths.append(p)
                often.append(o)
            if not blocks:
                continue
            leaves, deep = np.concatenate(paths), np.concatenate(often)
            paths.clear()
            order = np.argsort(leaves)
            leaves = leaves[order]
            twin = leaves[1:] == leaves[:-1]
            below = np.zeros(deep.size, bool)
            below[1:] |= twin
            below[:-1] |= twin
            deep[order] |= below
            for block, bits in zip(blocks, np.split(deep, np.cumsum(sizes)[:-1])):
                yield block, group, bits.size, np.packbits(bits).tobytes()

    yield from as_batches(rows(), _PARTS, 200)


def _gone(texts: list[bytes], hashes: WordHashes, table: np.ndarray, window: int, bits: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Words per text, and which of all words lie under a repeated window."""
    counts, starts, group, _, number = _windows(texts, hashes, table, window)
    deep = np.concatenate(bits).astype(bool) if bits else np.zeros(0, bool)
    if deep.size != group.size:
        raise ValueError(f"answers for {deep.size} of {group.size} windows")
    hit = starts[deep[number]] if starts.size else starts
    edges = np.zeros(int(counts.sum()) + 1, np.int64)
    np.add.at(edges, hit, 1)
    np.add.at(edges, hit + window, -1)
    return counts, np.cumsum(edges)[:-1] > 0


def _cut_texts(folder: str, table: np.ndarray, window: int, schema: pa.Schema):
    """Texts of a block without the words under repeated windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        hashes = WordHashes()

        def cut(block: str, answers: Iterator[dict]) -> Iterator[pa.RecordBatch]:
            bits = [np.unpackbits(np.frombuffer(r["data"], np.uint8), count=r["n"]) for r in answers if r["group"] != ALWAYS]
            with fs.open_input_stream(f"{base}/{block}", compression=None) as stream:
                data = zstandard.ZstdDecompressor().decompress(stream.read())
            parts = list(pa.ipc.open_stream(data))
            counts, gone = _gone(_texts(parts), hashes, table, window, bits)
            at = doc = 0
            for rows in parts:
                kept, removed = [], []
                for text, n in zip(_texts([rows]), counts[doc : doc + rows.num_rows].tolist()):
                    own, at = gone[at : at + n], at + n
                    words = text.split()
                    if own.any():
                        words = [words[i] for i in np.flatnonzero(~own)]
                    kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
                    removed.append(n - len(words))
                columns = [rows.column(0), pa.array(counts[doc : doc + rows.num_rows]), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
                doc += rows.num_rows
                yield pa.RecordBatch.from_arrays([*columns, *rows.columns[2:]], schema=schema)

        # What a block needs goes before the next one is read.
        for block, answers in _runs(batches, "block"):
            yield from cut(block, answers)

    return run


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, keep: tuple[str, ...] = (), group_windows: int = GROUP_WINDOWS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Remove each word under a window of `window` words whose sequence also starts elsewhere, in any text.

    Returns doc_id, n_words, n_removed, text (the kept words joined by one space) and the string columns `keep`. Windows are judged on the input: no
    occurrence stays. A null or empty text, or one shorter than the window, loses nothing. Rows count by themselves, so
    repeated rows remove each other whatever their ids, null included. An empty table gives no rows. Other columns are
    ignored. `docs` must read the same rows again when a task is repeated, as stored tables do. Windows are told apart by 64-bit hashes inside groups that split by other hashes of their first words.
    """
    spark = small_arrow_batches(docs.sparkSession)
    kept = [F.col(c).cast("string").alias(f"keep{i}") for i, c in enumerate(keep)]
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *kept)
    counted = rows.select("text").mapInArrow(_count_prefixes(window), "level int, slot int, n long")
    # At most len(PREFIXES) * SLOTS rows come back.
    counts = [tuple(r) for r in counted.groupBy("level", "slot").agg(F.sum("n").alias("n")).collect()]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = sum(n for level, _, n in counts if level == 0)
    table, _ = plan_groups(counts, window, max(1, min(group_windows, whole // (2 * partitions))))
    folder = shared_folder(spark, "suffixes")
    sent = rows.mapInArrow(_send_windows(folder, table, window, block_bytes), _PARTS_DDL)
    found = sent.repartition("group").sortWithinPartitions("group").mapInArrow(_find_nodes, _PARTS_DDL)
    found = stored_table(found, "nodes")
    # As many tasks as partitions: a block's file is much larger than the rows that ask for it.
    back = found.repartition(partitions, "block").sortWithinPartitions("block", "group")
    fields = [f"keep{i}" for i in range(len(keep))]
    schema = pa.schema([*_OUT, *[(f, pa.string()) for f in fields]])
    ddl = ", ".join(["doc_id long, n_words long, n_removed long, text string", *[f"{f} string" for f in fields]])
    return back.mapInArrow(_cut_texts(folder, table, window, schema), ddl).withColumnsRenamed(dict(zip(fields, keep)))

"""Near-duplicates by fast similarity sketching, banding and exact verification.

A sketch has T bins. In round i every shingle falls into a hashed bin with the value i + hash; a bin keeps its least
value. After T rounds each bin still empty takes all shingles in a round of its own, so every bin is filled, and
mostly after very few rounds. The share of equal bins of two sketches concentrates around their similarity. Bands of
bins put documents into buckets.

Equal sets are one representative from the start. Inside a bucket no pairs are listed: every member is compared with a
centre of the bucket, by its full set, for some orders of the members that choose other centres each time. What is
linked becomes one component, and pairs inside a component need no comparison. Only buckets that still hold several
components are completed: the members outside the bucket's largest component meet the members of other components, in
small buckets as pairs of rows, in large ones as tiles of texts that an index compares.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidex.llm.common import Scratch, WordHashes, arrow_schema, mix64, sequence_hashes, small_batches, stored_table
from evidex.llm.urlfilter import possible_hits

WORDS = 5
PERCENT = 80
BANDS, ROWS = 40, 5
BINS = BANDS * ROWS
STAR_ROUNDS = 4
LITTLE = 10
EDGES_PER_TASK = 1_000_000
SMALL_BUCKET = 32
POOL_BLOCK = 512
BATCH_BYTES = 2 << 20
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

_SEEDS = mix64(np.arange(1, 2 * BINS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_SKETCH = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64()))])


def shingle_sets(texts: list[bytes | None], hashes: WordHashes, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than a shingle are one shingle, none are none."""
    flat, counts = hashes.of([(t or b"").translate(LOWER) for t in texts])
    runs, out, start = sequence_hashes(flat, words), [], 0
    for n in counts.tolist():
        if n >= words:
            out.append(np.unique(runs[start : start + n - words + 1]))
        else:
            out.append(sequence_hashes(flat[start : start + n], n) if n else np.empty(0, np.uint64))
        start += n
    return out


def sketches(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """One row of `bins` values per set; a row of an empty set stays EMPTY."""
    sizes = np.array([s.size for s in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(sizes.size), sizes)
    table = np.full(sizes.size * bins, EMPTY)
    low = np.uint64(0xFFFFFFFF)
    for i in range(bins):
        if not flat.size:
            break
        h = mix64(flat ^ _SEEDS[i])
        at = owner * bins + ((h >> np.uint64(32)) % np.uint64(bins)).astype(np.int64)
        np.minimum.at(table, at, (h & low) + (np.uint64(i) << np.uint64(32)))
        full = (table.reshape(-1, bins) != EMPTY).all(axis=1)
        going = ~full[owner]
        flat, owner = flat[going], owner[going]
    for b in range(bins if flat.size else 0):
        h = mix64(flat ^ _SEEDS[bins + b])
        mine = table.reshape(-1, bins)[owner, b] == EMPTY
        np.minimum.at(table, owner[mine] * bins + b, (h[mine] & low) + (np.uint64(bins + b) << np.uint64(32)))
    return table.reshape(-1, bins)


def band_hashes(table: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit value per band, different for different bands."""
    cells = table.reshape(-1, bands, rows)
    out = np.broadcast_to(np.arange(bands, dtype=np.uint64), cells.shape[:2]).copy()
    for k in range(rows):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, k])
    return out.view(np.int64)


def _sketch(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in small_batches(batches, "text", BATCH_BYTES):
            sets = shingle_sets(batch.column(1).cast(pa.binary()).to_pylist(), hashes, words)
            bands = band_hashes(sketches(sets), BANDS, ROWS)
            sizes = np.array([s.size for s in sets], np.int64)
            offsets = np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS, 0))])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(bands[sizes > 0].ravel(), pa.int64()))
            digests = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), digests, lists], schema=_SKETCH)

    return run


def _packed_text():
    """Texts of representatives, packed for the comparisons."""
    schema = arrow_schema(rep=pa.int64(), data=pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in small_batches(batches, "text", BATCH_BYTES):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([packer.compress(t or b"") for t in texts], pa.binary())], schema=schema)

    return run


def _compare(words: int, percent: int):
    """The components of pairs whose full sets are similar enough."""
    schema = arrow_schema(a=pa.int64(), b=pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, hashes = zstandard.ZstdDecompressor().decompress, WordHashes()
        for batch in small_batches(batches, "x", BATCH_BYTES):
            x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            # Neighbouring rows share a side; each text is cut once in a batch.
            held = list(dict.fromkeys(x + y))
            sets = dict(zip(held, shingle_sets([unpack(d) for d in held], hashes, words)))
            linked = []
            for i, j in zip(x, y):
                both = np.intersect1d(sets[i], sets[j], assume_unique=True).size
                linked.append(100 * both >= percent * (sets[i].size + sets[j].size - both))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(linked)), batch.column(1).filter(pa.array(linked))], schema=schema)

    return run


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Components (a, b) that some of the pairs (a, b, ca, cb) link by their full sets. Joins split a text that many pairs share."""
    x = texts.select(F.col("rep").alias("a"), F.col("data").alias("x"))
    y = texts.select(F.col("rep").alias("b"), F.col("data").alias("y"))
    return pairs.join(y, "b").join(x, "a").select("ca", "cb", "x", "y").mapInArrow(_compare(words, percent), "a long, b long")


def _joined_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of a bounded list of edges: roots are hung below the smallest root around them until none moves."""
    parts = [np.column_stack([np.asarray(b.column(0)), np.asarray(b.column(1))]) for b in batches]
    edges = np.concatenate(parts) if parts else np.empty((0, 2), np.int64)
    nodes, at = np.unique(edges, return_inverse=True)
    at, root = at.reshape(-1, 2), np.arange(nodes.size)
    while at.size:
        ends = root[at]
        least = ends.min(axis=1)
        if (ends == least[:, None]).all():
            break
        np.minimum.at(root, ends[:, 0], least)
        np.minimum.at(root, ends[:, 1], least)
        while (root != root[root]).any():
            root = root[root]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(nodes[root], pa.int64())], names=["node", "component"])


def components(edges: DataFrame, scratch: Scratch, label: str = "components") -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its smallest node.

    Up to EDGES_PER_TASK edges are joined up by one task. More go through alternating stars: each node hands its
    neighbours the least node around it, first to larger and then to smaller ones, until nothing changes. Every step is
    written to the shared folder.
    """
    flat = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    now, state = scratch.table(flat, label), None
    if now.count() <= EDGES_PER_TASK:
        return scratch.table(now.coalesce(1).mapInArrow(_joined_up, "node long, component long"), label)
    while True:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        step = large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        now = scratch.table(step.filter("u <> v").distinct(), label)
        # A forest of stars: as many edges as nodes with a smaller neighbour, and no centre that is a leaf.
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v")).distinct()


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Bucket members with their component so far."""
    if labels is None:
        return members.withColumn("component", F.col("rep"))
    return members.join(labels, "rep")


def _relabelled(nodes: DataFrame, labels: DataFrame | None, links: DataFrame, scratch: Scratch) -> DataFrame:
    """(rep, component) after links between components: only what is new is joined up."""
    before = nodes.withColumn("component", F.col("rep")) if labels is None else labels
    found = components(links, scratch).select(F.col("node").alias("component"), F.col("component").alias("c"))
    return scratch.table(before.join(found, "component", "left").select("rep", F.coalesce("c", "component").alias("component")), "labels")


def _close(n: Column, m: Column, percent: int) -> Column:
    """Sets of these sizes can be similar enough."""
    return (100 * F.least(n, m)) >= (percent * F.greatest(n, m))


def _mixed(labelled: DataFrame) -> DataFrame:
    """Buckets that hold more than one component, with their largest one."""
    per = labelled.groupBy("bucket", "component").agg(F.count("*").alias("rows"))
    found = per.groupBy("bucket").agg(F.count("*").alias("parts"), F.sum("rows").alias("size"), F.max(F.struct("rows", "component"))["component"].alias("largest"))
    return found.filter("parts > 1")


def _tile_links(words: int, percent: int):
    """Links between components from tiles of two lists of texts, one for each pair of components in a tile."""
    schema = arrow_schema(a=pa.int64(), b=pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, hashes = zstandard.ZstdDecompressor().decompress, WordHashes()

        def sets_of(side: list[dict]) -> list[np.ndarray]:
            return shingle_sets([unpack(x["data"]) for x in side], hashes, words)

        for batch in batches:
            for row in batch.to_pylist():
                us, vs = row["us"], row["vs"]
                v_sets = sets_of(vs)
                sizes = np.array([s.size for s in v_sets], np.int64)
                component = np.array([v["component"] for v in vs], np.int64)
                # Which texts have a shingle: all shingles in order, each with its text.
                flat, owner = np.concatenate(v_sets), np.repeat(np.arange(sizes.size), sizes)
                order = np.argsort(flat, kind="stable")
                flat, owner = flat[order], owner[order]
                seen = set()
                for u, own in zip(us, sets_of(us)):
                    low, high = np.searchsorted(flat, own, "left"), np.searchsorted(flat, own, "right")
                    count = high - low
                    ends = np.cumsum(count)
                    at = np.repeat(low - (ends - count), count) + np.arange(ends[-1] if ends.size else 0)
                    common = np.bincount(owner[at], minlength=sizes.size)
                    near = (100 * common >= percent * (own.size + sizes - common)) & (component != u["component"])
                    for j in np.flatnonzero(near).tolist():
                        seen.add((min(u["component"], vs[j]["component"]), max(u["component"], vs[j]["component"])))
                if seen:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*sorted(seen))], schema=schema)

    return run


def _large_buckets(mixed: DataFrame, texts: DataFrame, words: int, percent: int, scratch: Scratch) -> DataFrame:
    """Links between components in buckets too large for pairs of rows.

    Buckets that share members are one pool. A pool is cut into blocks of texts; the blocks of members outside its largest
    component meet all blocks, and a tile counts common shingles through an index of its own. Pairs of rows are never
    made, and a tile hands on one link per pair of components.
    """
    first = mixed.groupBy("bucket").agg(F.min("rep").alias("first"))
    pools = components(mixed.join(first, "bucket").select(F.col("rep").alias("a"), F.col("first").alias("b")), scratch, "pools")
    rows = mixed.select("rep", "component").distinct().join(pools.select(F.col("node").alias("rep"), F.col("component").alias("pool")), "rep")
    per = rows.groupBy("pool", "component").agg(F.count("*").alias("rows"))
    sizes = per.groupBy("pool").agg(F.ceil(F.sum("rows") / POOL_BLOCK).alias("blocks"), F.max(F.struct("rows", "component"))["component"].alias("largest"))
    rows = rows.join(sizes, "pool").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks"))).join(texts, "rep")
    # A block holds about POOL_BLOCK texts, whatever the size of its pool.
    items = F.collect_list(F.struct("rep", "component", "data")).alias("vs")
    blocks = scratch.table(rows.groupBy("pool", "blocks", "largest", "block").agg(items), "blocks")
    us = blocks.select("pool", "blocks", F.filter("vs", lambda x: x["component"] != F.col("largest")).alias("us")).filter(F.size("us") > 0)
    us = us.select("pool", "us", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    return us.join(blocks.select("pool", "block", "vs"), ["pool", "block"]).select("us", "vs").mapInArrow(_tile_links(words, percent), "a long, b long")


def link(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Components of documents whose sets of `words`-word shingles are similar.

    Returns doc_id, n_shingles, component_id (the smallest doc_id reachable, itself included) and kept (doc_id =
    component_id). Linked are documents with 100 * |intersection| >= percent * |union|. Texts with fewer words are one
    shingle; null, empty and blank texts have the empty set and stand alone. Rows that repeat an id are linked by their
    own texts and are all kept if one is. Rows with a null id take no part: component_id is null and kept true. An empty
    table gives no rows. Other columns are ignored. A pair at the threshold shares no band, and may be missed if nothing
    else links it, with a probability of 1.3e-7.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketched = stored_table(rows.mapInArrow(_sketch(words), "doc_id long, n long, digest binary, bands array<long>"), "sketches")
    named = sketched.filter("n > 0 and doc_id is not null")
    # Equal sets: one representative. Partial minima, so large groups of copies send one row per task.
    reps = named.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.min("bands").alias("bands"))
    # An id may stand for several sets; the links of its sets are links of the id.
    members = reps.select("rep", "n", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1").select("bucket")
    scratch = Scratch(docs.sparkSession)
    members = scratch.table(members.join(shared, "bucket"), "members")

    nodes = scratch.table(members.select("rep").distinct(), "nodes")
    n_nodes = nodes.count()
    candidates = possible_hits(rows.filter(F.col("doc_id").isNotNull()), "doc_id", nodes, "rep", n_nodes)
    texts = candidates.join(nodes, candidates["doc_id"] == nodes["rep"], "left_semi")
    texts = scratch.table(texts.mapInArrow(_packed_text(), "rep long, data binary"), "texts")

    labels = None
    for round_ in range(STAR_ROUNDS):
        labelled = _labelled(members, labels)
        order = F.col("rep") if round_ == 0 else F.xxhash64("rep", F.lit(round_))
        # One pass over a bucket tells its centre and whether it still holds several components.
        centre = labelled.groupBy("bucket").agg(
            F.min(F.struct(order.alias("o"), "rep", "n", "component")).alias("centre"), F.min("component").alias("least"), F.max("component").alias("most")
        )
        centre = centre.filter("least <> most").select("bucket", "centre")
        pairs = labelled.join(centre, "bucket").filter((F.col("component") != F.col("centre.component")) & _close(F.col("n"), F.col("centre.n"), percent))
        pairs = pairs.select(F.col("centre.rep").alias("a"), F.col("rep").alias("b"), F.col("centre.component").alias("ca"), F.col("component").alias("cb")).distinct()
        new = scratch.table(verified(pairs, texts, words, percent), "links")
        n_new = new.count()
        if n_new:
            labels = _relabelled(nodes, labels, new, scratch)
        # A round that links little is left to the exact end.
        if n_new * LITTLE <= n_nodes:
            break

    # The rest, exactly. In small buckets whoever is outside the largest component meets the other components.
    labelled = _labelled(members, labels)
    mixed = scratch.table(labelled.join(_mixed(labelled), "bucket"), "mixed")
    least, most = mixed.agg(F.min("size"), F.max("size")).first()
    last = []
    if least is not None and least <= SMALL_BUCKET:
        small = mixed.filter(F.col("size") <= SMALL_BUCKET)
        outside = small.filter("component <> largest").select("bucket", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca"))
        others = small.select("bucket", F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"), (F.col("component") == F.col("largest")).alias("in_largest"))
        rest = outside.join(others, "bucket").filter((F.col("ca") != F.col("cb")) & (F.col("in_largest") | (F.col("a") < F.col("b"))) & _close(F.col("na"), F.col("nb"), percent))
        last.append(verified(rest.select("a", "b", "ca", "cb").distinct(), texts, words, percent))
    if most is not None and most > SMALL_BUCKET:
        last.append(_large_buckets(mixed.filter(F.col("size") > SMALL_BUCKET), texts, words, percent, scratch))
    if last:
        labels = _relabelled(nodes, labels, reduce(DataFrame.union, last), scratch)
    labels = nodes.withColumn("component", F.col("rep")) if labels is None else labels

    groups = stored_table(reps.select("digest", "rep").join(labels, "rep", "left").select(F.col("digest").alias("d"), F.coalesce("component", "rep").alias("c")), "groups")
    # What the result reads are the sketches and the groups; all else has done its work.
    scratch.drop()
    joined = (F.col("digest") == F.col("d")) & (F.col("n") > 0) & F.col("doc_id").isNotNull()
    out = sketched.select("doc_id", "n", "digest").join(groups, joined, "left")
    component = F.coalesce("c", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))

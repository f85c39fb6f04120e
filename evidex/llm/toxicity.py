"""Toxic spans by a linear-chain conditional random field.

Words get an evidence class from counts over the labelled documents of folds 1 to 3 (of fold 4 only the sample is used,
fold 0 is held out): how much more often the word, or else its longest counted beginning, occurs in toxic ones, less two standard errors. In toxic training documents words of strong
evidence are labelled toxic tokens, all others and all words of clean documents are not. A two-state chain learns from a
bounded sample of them what a class and its neighbours are worth. Forward-backward marginals give the spans, and their
sum, maximum and density give the document's score by a logistic fit on the same sample.

Most words are of class 0. Runs of them are one power of a 2 x 2 matrix, so the chain is exact over whole texts at the
cost of its few other words.

The features with a class are a table in the shared folder, however many they are. While they are proven few, each task
gets them all; else blocks of texts send their distinct words, which get their class by a join, with the same result.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidex.llm.common import CommittedFile, arrow_schema, as_batches, file_system, small_batches, stored_table
from evidex.llm.urlfilter import possible_hits
from evidex.session import shared_folder

# Bounds of what is fitted, and the documented limits of the model.
SAMPLE_PER_LABEL = 2_000
MIN_COUNT = 4
BEGINNINGS = (4, 5, 6, 7)
EDGES = (0.5, 1.5, 2.5, 3.5, 4.5)
TOXIC_CLASS = 2
CLASSES = len(EDGES) + 1
FIT_ROUNDS = 60
RIDGE = 0.5
CACHED_WORDS = 300_000
BATCH_BYTES = 2 << 20
# More features than this are not sent to the tasks but joined with the words.
BROADCAST_FEATURES = 40_000
BROADCAST_BYTES = 4 << 20
BLOCK_BYTES = 16 << 20

RowsWithEvidence = Callable[["Evidence", Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_TRIM = re.compile(r"^[\W_]+|[\W_]+$")


def features(word: str) -> list[str]:
    """A word's own feature and its beginnings, longest first."""
    core = _TRIM.sub("", word.lower())
    return [f"={core}", *[f"^{core[:k]}" for k in sorted(BEGINNINGS, reverse=True) if len(core) > k]] if core else []


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per word and label, summed in the task."""
    schema = arrow_schema(word=pa.string(), t=pa.int64(), c=pa.int64())
    held: dict[bytes, list[int]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        rows = ((w.decode("utf-8", "replace"), t, c) for w, (c, t) in held.items())
        yield from as_batches(rows, schema, 20_000)
        held.clear()

    for batch in small_batches(batches, "text", BATCH_BYTES):
        for text, label in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()):
            for w in set((text or b"").split()):
                held.setdefault(w, [0, 0])[label] += 1
        if len(held) > CACHED_WORDS:
            yield from flush()
    yield from flush()


def lexicon(labelled: DataFrame) -> DataFrame:
    """feature, class of all features of positive evidence and of those that stop them, from text, toxic."""
    counted = labelled.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(_count_words, "word string, t long, c long")
    per_word = counted.groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    core = F.regexp_replace(F.lower("word"), r"(?U)^[\W_]+|[\W_]+$", "")
    per_word = stored_table(per_word.select(core.alias("core"), "t", "c").filter("core <> ''"), "words")
    whole = per_word.agg(F.sum("t"), F.sum("c")).first()
    beginnings = [F.when(F.length("core") > k, F.concat(F.lit("^"), F.substring("core", 1, k))) for k in BEGINNINGS]
    found = F.array_compact(F.array(F.concat(F.lit("="), "core"), *beginnings))
    counts = per_word.select(F.explode(found).alias("feature"), "t", "c").groupBy("feature").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    counts = counts.filter(F.col("t") + F.col("c") >= MIN_COUNT)
    odds = F.log((F.col("t") + 0.5) / (F.lit(whole[0] or 0) + 1)) - F.log((F.col("c") + 0.5) / (F.lit(whole[1] or 0) + 1))
    counts = counts.withColumn("evidence", F.round(odds - 2 * F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5)), 9))
    # Features without positive evidence are kept if they stop a shorter one from speaking: a known word is its own judge.
    speaks = (F.col("t") >= 2) & (F.col("evidence") >= EDGES[0])
    best = stored_table(counts.filter(speaks).select("feature", "evidence"), "speaking")
    speaking = best.select(F.col("feature").alias("short"))
    stop = counts.filter(~speaks & F.col("feature").startswith("=")).select("feature", F.explode(F.array(*[F.concat(F.lit("^"), F.substring("feature", 2, k)) for k in BEGINNINGS])).alias("short"))
    stop = stop.join(speaking, "short", "left_semi").select("feature").distinct()
    strength = sum((F.col("evidence") >= edge).cast("int") for edge in EDGES)
    return stored_table(best.select("feature", strength.alias("class")).union(stop.select("feature", F.lit(0).alias("class"))), "lexicon")


class Lexicon:
    """The table of features, and a dictionary of them while a count proves them few."""

    def __init__(self, table: DataFrame):
        n, size = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("feature")), F.lit(0))).first()
        few = n <= BROADCAST_FEATURES and size <= BROADCAST_BYTES
        self.table, self.known = table, {r["feature"]: r["class"] for r in table.collect()} if few else None


class Evidence:
    """Classes of words, kept until the store is full."""

    def __init__(self, known: dict[str, int]):
        self.lexicon, self.words = known, {}

    def active(self, text: bytes | None) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of words, and positions and classes of those above class 0."""
        words = (text or b"").split()
        new = [w for w in set(words) if w not in self.words]
        if len(self.words) + len(new) > CACHED_WORDS:
            self.words.clear()
            new = list(set(words))
        for w in new:
            self.words[w] = self.look_up(w)
        classes = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        at = np.flatnonzero(classes)
        return len(words), at, classes[at]

    def look_up(self, word: bytes) -> int:
        return next((self.lexicon[f] for f in features(word.decode("utf-8", "replace")) if f in self.lexicon), 0)


class BlockEvidence(Evidence):
    """Classes of the words of one block, joined before; words that are not there are of class 0."""

    def __init__(self, classes: dict[bytes, int]):
        super().__init__({})
        self.classes = classes

    def look_up(self, word: bytes) -> int:
        return self.classes.get(word, 0)


def _cut_blocks(folder: str, block_bytes: int):
    """Rows go to one file per block; (block, distinct word) come out, and an empty word for the block itself."""
    schema = arrow_schema(block=pa.string(), word=pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, words = 0, {b""}

        def close() -> Iterator[pa.RecordBatch]:
            block = f"{uuid.uuid4().hex}.arrow"
            data = pa.BufferOutputStream()
            with pa.ipc.new_stream(data, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                for batch in held:
                    stream.write_batch(batch)
            out = CommittedFile(folder, block)
            out.write(data.getvalue())
            out.commit()
            yield from as_batches(((block, w) for w in words), schema, 20_000)

        for batch in small_batches(batches, "text", BATCH_BYTES):
            held.append(batch)
            size += batch.nbytes
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                words.update((text or b"").split())
            if size >= block_bytes:
                yield from close()
                held, size, words = [], 0, {b""}
        if held:
            yield from close()

    return run


def _features_of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, place, feature) of each word, the feature that counts first with the lowest place."""
    schema = arrow_schema(word=pa.binary(), place=pa.int32(), feature=pa.string())
    for batch in batches:
        words = batch.column(0).to_pylist()
        yield from as_batches(((w, n, f) for w in words for n, f in enumerate(features(w.decode("utf-8", "replace")))), schema, 20_000)


def _read_blocks(folder: str, run: RowsWithEvidence):
    """Each block's rows with the classes that its words got."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for block, group in groupby(rows, key=lambda r: r[0]):
            classes = {word: found for _, word, found in group if found}
            with fs.open_input_stream(f"{base}/{block}", compression=None) as stream:
                yield from run(BlockEvidence(classes), pa.ipc.open_stream(stream))

    return read


def with_evidence(docs: DataFrame, lexicon: Lexicon, run: RowsWithEvidence, ddl: str) -> DataFrame:
    """`run` over the rows of doc_id, text and more, with the evidence of their words."""
    known = lexicon.known
    if known is not None:
        return docs.mapInArrow(lambda batches: run(Evidence(known), batches), ddl)
    spark = docs.sparkSession
    folder = shared_folder(spark, "texts")
    asked = stored_table(docs.mapInArrow(_cut_blocks(folder, BLOCK_BYTES), "block string, word binary"), "words")
    own = asked.select("word").distinct().mapInArrow(_features_of_words, "word binary, place int, feature string")
    classes = own.join(lexicon.table.hint("merge"), "feature").groupBy("word").agg(F.min_by("class", "place").alias("class")).filter("class > 0")
    answered = asked.join(classes.hint("merge"), "word", "left").filter("class is not null or word = X''").select("block", "word", "class")
    # As many tasks as slots: a block's file is much larger than the rows that ask for it.
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return answered.repartition(slots, "block").sortWithinPartitions("block").mapInArrow(_read_blocks(folder, run), ddl)


class Chains:
    """Sequences by their active words, padded and with the most active first."""

    def __init__(self, rows: list[tuple[int, np.ndarray, np.ndarray]]):
        self.order = sorted(range(len(rows)), key=lambda i: -rows[i][1].size)
        sizes = np.array([rows[i][1].size for i in self.order], np.int64)
        self.sizes, width = sizes, int(sizes.max(initial=0))
        self.running = [int((sizes > j).sum()) for j in range(width)]
        self.classes = np.zeros((len(rows), width), np.int64)
        self.gaps = np.zeros((len(rows), width), np.int64)
        self.tail = np.zeros(len(rows), np.int64)
        for n, i in enumerate(self.order):
            length, at, classes = rows[i]
            self.classes[n, : at.size] = classes
            # Words of class 0 before each active one, and after the last.
            self.gaps[n, : at.size] = np.diff(at, prepend=-1) - 1
            self.tail[n] = length - 1 - at[-1] if at.size else length


class Field:
    """Potentials of the chain for one or several parameter vectors: (start, 0-1, 1-0, 1-1, weight per class)."""

    def __init__(self, theta: np.ndarray):
        self.theta = np.atleast_2d(theta)
        e = np.exp(self.theta)
        one = np.ones(len(e))
        self.start = np.stack([one, e[:, 0]], axis=1)
        self.move = np.stack([np.stack([one, e[:, 1]], axis=1), np.stack([e[:, 2], e[:, 3]], axis=1)], axis=1)
        self.emit = np.stack([np.ones((len(e), CLASSES)), e[:, 4:]], axis=2)
        # Spectral form of a step into a word of class 0.
        a = self.move * self.emit[:, None, 0, :]
        trace, det = a[:, 0, 0] + a[:, 1, 1], a[:, 0, 0] * a[:, 1, 1] - a[:, 0, 1] * a[:, 1, 0]
        root = np.sqrt(np.maximum(trace * trace / 4 - det, 1e-300))
        self.top, other = trace / 2 + root, trace / 2 - root
        eye = np.eye(2)[None]
        self.first = (a - other[:, None, None] * eye) / (2 * root)[:, None, None]
        self.second = (self.top[:, None, None] * eye - a) / (2 * root)[:, None, None]
        self.ratio = other / self.top

    def run(self, k: np.ndarray) -> np.ndarray:
        """k steps through class 0, divided by the k-th power of `top`: (vectors, chains, 2, 2)."""
        power = np.where(k[None, :] > 0, np.sign(self.ratio)[:, None] ** k[None, :], 1) * np.exp(k[None, :] * np.log(np.abs(self.ratio) + 1e-300)[:, None])
        return self.first[:, None] + power[:, :, None, None] * self.second[:, None]

    def _enter(self, k: np.ndarray) -> np.ndarray:
        """State weights after the first k words of class 0, before a move if k > 0: a pseudo-start is moved into."""
        begun = (self.start * self.emit[:, 0])[:, None, None, :]
        ran = np.matmul(begun, self.run(np.maximum(k - 1, 0)))[:, :, 0, :]
        return ran

    def forward(self, chains: Chains) -> tuple[list[np.ndarray], np.ndarray]:
        """Normalised weights at each active word, and log Z per vector and chain."""
        n = len(chains.tail)
        scale = np.zeros((len(self.theta), n))
        log_top = np.log(self.top)[:, None]
        state = np.zeros((len(self.theta), n, 2))
        steps = []
        for j, m in enumerate(chains.running):
            k, c = chains.gaps[:m, j], chains.classes[:m, j]
            emit = self.emit[:, c]
            if j == 0:
                ran = np.matmul(self._enter(k)[:, :, None, :], self.move[:, None])[:, :, 0, :]
                now = np.where((k > 0)[None, :, None], ran, self.start[:, None, :]) * emit
                scale[:, :m] += np.maximum(k - 1, 0)[None, :] * log_top
            else:
                ran = np.matmul(state[:, :m, None, :], np.matmul(self.run(k), self.move[:, None]))[:, :, 0, :]
                now = ran * emit
                scale[:, :m] += k[None, :] * log_top
            total = now.sum(axis=2)
            scale[:, :m] += np.log(total)
            state[:, :m] = now / total[:, :, None]
            steps.append(state[:, :m].copy())
        none = chains.sizes == 0
        k = chains.tail
        end = np.matmul(state[:, :, None, :], self.run(k))[:, :, 0, :].sum(axis=2)
        alone = np.where(k[None, :] > 0, self._enter(k).sum(axis=2), 1.0)
        scale += np.where(none, np.maximum(k - 1, 0), k)[None, :] * log_top + np.log(np.where(none[None, :], alone, np.where(end > 0, end, 1.0)))
        return steps, scale

    def marginals(self, chains: Chains) -> list[np.ndarray]:
        """Probability of the toxic state at each active word of each chain, in the chains' own order."""
        steps, _ = self.forward(chains)
        n = len(chains.tail)
        out = np.zeros((n, len(chains.running)))
        back = np.matmul(self.run(chains.tail), np.ones(2)[None, None, :, None])[0, :, :, 0]
        for j in range(len(chains.running) - 1, -1, -1):
            m = chains.running[j]
            both = steps[j][0] * back[:m]
            out[:m, j] = both[:, 1] / both.sum(axis=1)
            if j:
                into = np.matmul(self.run(chains.gaps[:m, j]), self.move[:, None])[0]
                seen = self.emit[0, chains.classes[:m, j]] * back[:m]
                new = np.matmul(into, seen[:, :, None])[:, :, 0]
                back[:m] = new / new.sum(axis=1, keepdims=True)
        result: list[np.ndarray] = [np.empty(0)] * n
        for i, where in enumerate(chains.order):
            result[where] = out[i, : chains.sizes[i]]
        return result


def fit_field(rows: list[tuple[int, np.ndarray, np.ndarray]], toxic: np.ndarray, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Parameters of greatest penalised likelihood, by steps that follow the sign of each slope."""
    chains = Chains(rows)
    seen = np.zeros(4 + CLASSES)
    for (length, at, classes), label in zip(rows, toxic):
        if label:
            mine = classes >= TOXIC_CLASS
            spots = at[mine]
            seen[4:] += np.bincount(classes[mine], minlength=CLASSES)
            after = np.diff(spots) == 1
            begins = spots.size - after.sum()
            seen[0] += spots.size > 0 and spots[0] == 0
            seen[3] += after.sum()
            seen[1] += begins - (spots.size > 0 and spots[0] == 0)
            seen[2] += begins - (spots.size > 0 and spots[-1] == length - 1)
    theta = np.zeros(4 + CLASSES)
    theta[:3], theta[4:] = (-4.0, -4.0, 0.0), np.linspace(-2.0, 4.0, CLASSES)
    step, last, h = np.full(theta.size, 0.5), np.zeros(theta.size), 1e-4
    for _ in range(rounds):
        moved = theta[None, :] + np.vstack([np.eye(theta.size) * h, -np.eye(theta.size) * h])
        _, logz = Field(moved).forward(chains)
        z = logz.sum(axis=1)
        slope = seen - (z[: theta.size] - z[theta.size :]) / (2 * h) - RIDGE * theta
        sign = np.sign(slope) * np.sign(last)
        step = np.clip(np.where(sign > 0, step * 1.3, np.where(sign < 0, step * 0.5, step)), 1e-4, 1.0)
        theta, last = np.clip(theta + np.sign(slope) * step, -20, 20), slope
    return np.round(theta, 6)


def _summary(n_words: np.ndarray, marginals: list[np.ndarray]) -> np.ndarray:
    """Expected toxic words, the highest marginal, and toxic words per hundred, of each document."""
    total = np.array([m.sum() for m in marginals])
    most = np.array([m.max(initial=0.0) for m in marginals])
    return np.stack([np.ones(total.size), np.log1p(total), most, np.log1p(100 * total / np.maximum(n_words, 1))], axis=1)


def fit_scores(x: np.ndarray, y: np.ndarray, share: float) -> np.ndarray:
    """Logistic weights by Newton steps; the intercept is moved to the share of toxic labels."""
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - 0.1 * w
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(w.size), grad)
    have = min(max(y.mean(), 1e-6), 1 - 1e-6) if y.size else 0.5
    share = min(max(share, 1e-6), 1 - 1e-6)
    w[0] += np.log(share / (1 - share)) - np.log(have / (1 - have))
    return np.round(w, 9)


def _fold(doc_id: Column) -> Column:
    """crc32 of the id as text, by five; a null id is as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def train(docs: DataFrame, labels: DataFrame) -> tuple[Lexicon, np.ndarray, np.ndarray]:
    """(lexicon, chain, score weights) from doc_id, text and doc_id, toxic of the rows that are not held out.

    Folds 1 to 3 count words, all of them; fold 4 gives the sample that chain and scores are fitted on, at most
    SAMPLE_PER_LABEL documents per label, by hashed id, so that evidence is not judged where it was counted.
    """
    marked = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    marked = stored_table(marked.withColumn("fold", _fold(F.col("doc_id"))).filter("fold <> 0"), "marked")
    counted = marked.filter("fold between 1 and 3")
    # Texts without a label stay where they are.
    texts = possible_hits(docs.filter("doc_id is not null"), "doc_id", counted, "doc_id", counted.count())
    known = Lexicon(lexicon(texts.join(counted, "doc_id")))
    rest = marked.filter("fold = 4")
    picked = None
    for label in (0, 1):
        some = rest.filter(F.col("toxic") == label).select("doc_id", "toxic").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_PER_LABEL)
        picked = some if picked is None else picked.union(some)
    picked = stored_table(picked.distinct().withColumnRenamed("doc_id", "picked_id"), "sample")
    schema = pa.schema([("toxic", pa.int32()), ("n", pa.int64()), ("at", pa.list_(pa.int64())), ("classes", pa.list_(pa.int64())), ("doc_id", pa.int64())])

    def run(evidence: Evidence, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BATCH_BYTES):
            found = [evidence.active(t) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), pa.array([f[0] for f in found]), pa.array([f[1].tolist() for f in found], schema.types[2]), pa.array([f[2].tolist() for f in found], schema.types[3]), batch.column(0)], schema=schema
            )

    sample = docs.join(F.broadcast(picked), F.col("doc_id") == F.col("picked_id")).select("doc_id", "text", F.col("toxic").cast("int"))
    # A row per id, of the lowest hash of its texts: at most two samples of rows, each as long as its words with evidence.
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), F.col("text").alias("text")))
    sample = sample.groupBy("doc_id").agg(least.alias("row"), F.max("toxic").alias("toxic")).select("doc_id", "row.text", "toxic")
    rows = with_evidence(sample, known, run, "toxic int, n long, at array<long>, classes array<long>, doc_id long").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["n"], r["at"]))
    chains = [(r["n"], np.array(r["at"], np.int64), np.array(r["classes"], np.int64)) for r in rows]
    toxic = np.array([r["toxic"] > 0 for r in rows], bool)
    theta = fit_field(chains, toxic)
    share = marked.agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0] or 0.0
    x = _summary(np.array([c[0] for c in chains], np.int64), Field(theta).marginals(Chains(chains)) if chains else [])
    return known, theta, fit_scores(x, toxic.astype(float), share)


def score(docs: DataFrame, model: tuple[Lexicon, np.ndarray, np.ndarray], least: float = 0.5) -> DataFrame:
    """doc_id, score, spans (start and end of each run of toxic words, in characters) of doc_id, text."""
    known, theta, weights = model
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("spans", pa.list_(span))])

    def spans(text: bytes, at: np.ndarray, p: np.ndarray) -> list[dict]:
        hits = at[p >= least]
        if not hits.size:
            return []
        places = [m.span() for m in WORD.finditer(text.decode("utf-8", "replace"))]
        runs = np.split(hits, np.flatnonzero(np.diff(hits) > 1) + 1)
        return [{"start": places[r[0]][0], "end": places[r[-1]][1]} for r in runs]

    def run(evidence: Evidence, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field(theta)
        for batch in small_batches(batches, "text", BATCH_BYTES):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            rows = [evidence.active(t) for t in texts]
            marginals = field.marginals(Chains(rows))
            x = _summary(np.array([r[0] for r in rows], np.int64), marginals)
            scores = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            found = [spans(t or b"", r[1], m) for t, r, m in zip(texts, rows, marginals)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.round(scores, 9)), pa.array(found, schema.types[2])], schema=schema)

    return with_evidence(docs, known, run, "doc_id long, score double, spans array<struct<start:long,end:long>>")


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Score every text: doc_id, held_out, score, predicted, spans.

    Labels are learnt from rows whose crc32 of the id, modulo 5, is not 0; the others are held out. Null and empty texts
    have no spans and the score of a text without evidence. Rows are scored one by one, repeated and null ids included
    (a null id counts as held out: its text is empty). Without labels, or of one kind only, the scores follow the
    share of toxic labels. An empty table gives no rows. Other columns are ignored; a document with several labels is toxic if
    one says so.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = score(rows, train(rows, labels.select("doc_id", "toxic")))
    return found.select("doc_id", (_fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")

"""Mixing sources to target weights by a low-discrepancy schedule.

The documents of a source, in a hashed order, form one stream of words that is cut into blocks of equal length. Slot k
of the schedule takes the point k * golden ratio (mod 1), which a table of cumulative targets maps to a source. The
r-th slot of a source takes block r of its stream, and begins again after the last block. Ranks come from counts per
range of slots, so that no source's slots, documents or blocks ever meet in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidex.llm.common import stored_table, words

GOLDEN = (math.sqrt(5) - 1) / 2
BLOCK_WORDS = 64
MAX_EPOCHS = 3
ROWS_PER_BUCKET = 2_000
SLOTS_PER_RANGE = 100_000
# Rows alike are numbered in runs of 2^14 numbers of rows.
ROW_BITS = 14


def _ranked(sources: DataFrame) -> DataFrame:
    """Number sources (column `source`) by code point from 0, null last, without one global sort."""
    parts = sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    parts = stored_table(parts, "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    offsets = parts.groupBy("part").count().withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    inside = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return parts.join(offsets.select("part", "before"), "part").withColumn(
        "place", F.col("before") + F.row_number().over(inside) - 1
    ).drop("part", "before")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Target words per source from (source, source_size).

    Sources by code point, null last, weigh `weights`, repeating, and share all words; a target stops at `max_epochs`
    times its source's size and the excess goes to the others by weight until none is above.
    """
    weigh = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    found = stored_table(_ranked(sizes).withColumn("weight", weigh).withColumn("most", F.lit(float(max_epochs)) * F.col("source_size")), "weights")
    whole = float(found.agg(F.sum("source_size")).first()[0] or 0)
    per_weight = 0.0
    # Each round closes at least one more source; rounds follow the number of distinct size-to-weight ratios in
    # the way, a handful in practice. Two sums travel per round.
    closed = -1
    while True:
        above = F.col("most") <= F.lit(per_weight) * F.col("weight")
        row = found.agg(
            F.sum(F.when(above, F.col("most")).otherwise(0.0)).alias("given"),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("open"),
            F.sum(above.cast("long")).alias("closed"),
        ).first()
        if row["closed"] is None or row["closed"] == closed or not row["open"]:
            break
        closed, per_weight = row["closed"], (whole - row["given"]) / row["open"]
    return found.withColumn("target", F.least("most", F.lit(per_weight) * F.col("weight")))


def _copies(rows: DataFrame) -> DataFrame:
    """Rows with `copy`: 0, 1, ... among those of equal `same`, in any order, as they are alike.

    Counts per run of row numbers come first, so rows alike never meet in one task.
    """
    rows = rows.withColumn("part", F.shiftright("row", ROW_BITS))
    before = Window.partitionBy("same").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("same", "part").count().withColumn("before", F.sum("count").over(before))
    counts = counts.filter("before is not null").select("same", "part", "before")
    inside = Window.partitionBy("same", "part").orderBy("row")
    numbered = rows.withColumn("n", F.row_number().over(inside) - 1).join(counts, ["same", "part"], "left")
    return numbered.withColumn("copy", F.coalesce("before", F.lit(0)).cast("long") + F.col("n")).drop("part", "before", "n")


def blocks(documents: DataFrame, block_words: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Pieces of documents in equal-word blocks: row, source, block, piece (words of the document in the block).

    Takes row (one number per document), key (a hash that orders a source), source, size. Running sums go over ranges
    of keys first, so a source with a third of all rows is split.
    """
    most = documents.groupBy("source").count().agg(F.max("count")).first()[0] or 1
    buckets = max(1, math.ceil(most / rows_per_bucket))
    rows = documents.filter("size > 0").withColumn("bucket", F.pmod(F.shiftrightunsigned("key", 1), F.lit(buckets)))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    sums = sums.withColumn("offset", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    sums = sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"), "offset")
    joined = rows.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).drop("s", "b")
    inside = Window.partitionBy("source", "bucket").orderBy("key", "size", "row").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    placed = joined.withColumn("start", start).withColumn("end", F.col("start") + F.col("size"))
    cut = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block_words), F.floor((F.col("end") - 1) / block_words))))
    low, high = F.greatest("start", F.col("block") * block_words), F.least("end", (F.col("block") + 1) * block_words)
    return cut.select("row", "source", "block", (high - low).alias("piece"))


def schedule(shares: DataFrame, block_words: int, slots_per_range: int = SLOTS_PER_RANGE) -> DataFrame:
    """The slots of the mix: slot, source, rank (of the slot in its source), block, epoch.

    Takes source, source_size, target. Slots whose rank would start more than the allowed epochs are not there, as
    targets stop at that size.
    """
    spark = shares.sparkSession
    whole = float(shares.agg(F.sum("target")).first()[0] or 0)
    n_slots = math.ceil(whole / block_words)
    upto = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    # One row per source; the points below are joined by their cell of a fixed grid.
    bounds = shares.filter("target > 0").select("place", "source", "source_size", "target", F.sum("target").over(upto).alias("high"))
    bounds = bounds.withColumn("low", F.coalesce(F.lag("high").over(Window.orderBy("place")), F.lit(0.0)))
    grid = 1024
    last = F.least(F.floor(F.col("high") / whole * grid), F.lit(grid - 1)) if whole else F.lit(0)
    cells = bounds.withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / (whole or 1) * grid), last)))
    points = spark.range(n_slots).select(F.col("id").alias("slot"), F.expr(f"id * {GOLDEN!r}D - floor(id * {GOLDEN!r}D)").alias("point"))
    points = points.withColumn("at", F.col("point") * whole).withColumn("cell", F.floor(F.col("point") * grid))
    hit = points.join(cells, "cell").filter((F.col("at") >= F.col("low")) & (F.col("at") < F.col("high")))
    hit = hit.select("slot", "place", "source", "source_size", F.floor(F.col("slot") / slots_per_range).alias("range"))
    counts = hit.groupBy("place", "range").count()
    earlier = Window.partitionBy("place").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("count").over(earlier), F.lit(0))).drop("count")
    inside = Window.partitionBy("place", "range").orderBy("slot")
    ranked = hit.join(counts, ["place", "range"]).withColumn("rank", F.col("before") + F.row_number().over(inside) - 1)
    n_blocks = F.ceil(F.col("source_size") / block_words)
    ranked = ranked.withColumn("block", F.col("rank") % n_blocks).withColumn("epoch", F.floor(F.col("rank") / n_blocks))
    return ranked.filter(F.col("epoch") < MAX_EPOCHS).select("slot", "source", "rank", "block", "epoch")


def mix(
    docs: DataFrame,
    row_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = (1.0, 2.0, 3.0),
    block_words: int = BLOCK_WORDS,
    keep: tuple[str, ...] = (),
    row: str | None = None,
) -> DataFrame:
    """What the mix takes of each document: row_id, size, source, source_size, target, taken (words, repeats counted).

    A null text or a text without words has size 0 and is never taken. A null source is a source, and comes last.
    Every row is a document of its own, also where ids repeat or are null: rows are put in order by a hash of id, text
    and the number of the row among equal ones. A source's words end within one block of its slots, and no row is
    taken more than three times. Columns in `keep` are handed on, others are ignored. The same rows give the same mix,
    in any order or partitioning; an empty table gives no rows.

    `row` is a column that numbers the rows and reads the same again, as of `numbered_table`: columns in `keep` are then
    read from `docs` once more. Without it rows are numbered here and stored with these columns.
    """
    number = F.monotonically_increasing_id() if row is None else F.col(row)
    sized = docs.select(
        F.col(row_id).alias("row_id"), F.col(source).alias("source"), F.size(words(F.col(text))).cast("long").alias("size"),
        F.xxhash64(text).alias("text_key"), *(keep if row is None else ()), number.alias("row"),
    )
    # Stored, so that a row keeps its number whatever is read again.
    sized = stored_table(sized, "sizes")
    shares = stored_table(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights), "targets")
    rows = sized.select("row_id", "source", "size", "text_key", "row").withColumn("same", F.xxhash64("row_id", "source", "text_key"))
    rows = _copies(rows).select("row", "source", "size", F.xxhash64("row_id", "text_key", "copy").alias("key"))
    slots = schedule(shares, block_words)
    passes = slots.groupBy("source", "block").agg(F.count("*").alias("passes")).withColumnsRenamed({"source": "s", "block": "b"})
    pieces = blocks(stored_table(rows, "rows"), block_words)
    met = pieces.join(passes, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    taken = met.groupBy("row").agg(F.sum(F.col("piece") * F.col("passes")).alias("words"))
    share = shares.select(F.col("source").alias("t"), "source_size", "target")
    found = sized.join(taken, "row", "left").join(share, F.col("source").eqNullSafe(F.col("t")))
    if row is not None and keep:
        found = found.join(docs.select(F.col(row).alias("row"), *keep), "row")
    return found.select("row_id", "source", "size", "source_size", "target", F.coalesce("words", F.lit(0)).cast("long").alias("taken"), *keep)

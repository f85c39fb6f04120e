"""Quality rules by weak supervision, in DataFrame functions only.

Rules read counts of a text and vote good (1), bad (-1) or abstain (0). Documents are counted by their pattern of votes,
at most 3 to the power of the number of rules. Expectation-maximisation on those counts estimates how often each rule is
right on good and on bad documents, and the share of good ones; a document is kept if its posterior probability of being
good is high enough. An abstention says nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidex.llm.common import spaced, stored_table, words

# Fixed values of the base counts.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20

# Where estimates start and how far they may go: right on good documents, right on bad ones, share of good ones. A bad
# vote always speaks against a document and a good one for it, which keeps the two classes from changing places.
START_ON_GOOD, ON_GOOD = 0.98, (0.95, 0.999)
START_ON_BAD, ON_BAD = 0.3, (0.1, 0.95)
START_GOOD, GOOD = 0.85, (0.5, 0.99)
ROUNDS = 25
SMOOTHING = 1.0


def base_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and what the rules need besides."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Each array is made once: the step names keep Spark from repeating it for every mention.
    rows = rows.select("doc_id", "text", words(F.col("text")).alias("w"), F.filter(F.split("text", "\n"), lambda x: F.trim(spaced(x)) != "").alias("lines"))
    rows = rows.withColumn("n_words", F.size("w").cast("long"))
    # Windows as hashes first: no equal hash, no equal window. Texts with one are looked at word by word.
    starts = F.when(F.col("n_words") > WINDOW, F.sequence(F.lit(1), F.size("w") - (WINDOW - 1))).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn("h", F.transform(starts, lambda i: F.xxhash64(*[F.get("w", i + (k - 1)) for k in range(WINDOW)])))
    again = F.size(F.array_distinct("h")) < F.size("h")
    windows = F.transform(starts, lambda i: F.array_join(F.slice("w", i, WINDOW), " "))
    pairs = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    rows = rows.withColumn("p", F.when(again, pairs))
    last = F.size("p") - 1
    same = F.filter(
        F.col("p"),
        lambda x, i: ((i > 0) & (F.get("p", F.greatest(i - 1, F.lit(0)))["x"] == x["x"])) | ((i < last) & (F.get("p", F.least(i + 1, last))["x"] == x["x"])),
    )
    rows = rows.withColumn("s", F.when(again, F.sort_array(F.transform(same, lambda x: x["i"]))))
    # Words under repeated windows: each start covers up to the next one, five at most.
    covered = F.aggregate(
        F.col("s"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("at")),
        lambda acc, i: F.struct((acc["n"] + F.least(i - acc["at"], F.lit(WINDOW))).alias("n"), i.alias("at")),
        lambda acc: acc["n"],
    )
    symbols = sum((F.length("text") - F.length(F.replace("text", F.lit(c), F.lit(""))) for c in SYMBOLS[1:]), F.length("text") - F.length(F.replace("text", F.lit(SYMBOLS[0]), F.lit(""))))
    capitals = F.size(F.filter("w", lambda x: (F.length(x) > 1) & (x == F.upper(x)) & (x != F.lower(x))))
    return rows.select(
        "doc_id",
        "n_words",
        F.length(F.replace(spaced(F.col("text")), F.lit(" "), F.lit(""))).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        capitals.cast("long").alias("n_capitals"),
        F.size(F.filter("w", lambda x: x.rlike("[.!?]$"))).cast("long").alias("n_ends"),
        F.size(F.filter("w", lambda x: x.rlike("[#*$%&|<>]"))).cast("long").alias("n_marked"),
        F.length(F.regexp_replace("text", r"[^\p{L}\p{N}]+", "")).cast("long").alias("n_letters"),
    )


def _vote(bad: Column, good: Column) -> Column:
    return F.coalesce(F.when(bad, -1).when(good, 1), F.lit(0))


def votes() -> dict[str, Column]:
    """The rules. Each abstains between its two limits, and where a text is too short for it."""
    n = F.col("n_words")
    enough = n >= 30
    return {
        "symbols": _vote(F.col("n_symbols") * 20 > F.col("word_chars"), F.col("n_symbols") * 100 < F.col("word_chars")),
        "repeats": _vote(F.col("n_repeat_words") * 10 > n, F.col("n_repeat_words") * 20 <= n),
        "marked": _vote(F.col("n_marked") * 5 > n, F.col("n_marked") * 50 < n),
        "letters": _vote(F.col("n_letters") * 100 < F.col("word_chars") * 90, F.col("n_letters") * 100 > F.col("word_chars") * 95),
        "lines": _vote((F.col("n_lines") >= 4) & (F.col("n_dup_lines") * 2 > F.col("n_lines")), (F.col("n_lines") >= 3) & (F.col("n_dup_lines") * 10 <= F.col("n_lines"))),
        "length": _vote((n > 0) & ((F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n)), (F.col("word_chars") >= 3 * n) & (F.col("word_chars") <= 12 * n)),
        "capitals": _vote(F.col("n_capitals") * 10 > n * 4, F.col("n_capitals") * 10 < n),
        "variety": _vote(enough & (n <= 500) & (F.col("n_distinct") * 10 < n * 3), enough & (n <= 500) & (F.col("n_distinct") * 2 > n)),
        "sentences": _vote(enough & (F.col("n_ends") * 100 < n), F.col("n_ends") * 50 > n),
        "short": _vote(n < MIN_WORDS, n >= 2 * MIN_WORDS),
    }


def _posterior(model: dict[str, tuple[float, float]], good: float) -> Column:
    """Probability that a pattern of votes comes from a good document."""
    score = F.lit(math.log(good / (1 - good)))
    for name, (on_good, on_bad) in model.items():
        against, for_it = math.log((1 - on_good) / on_bad), math.log(on_good / (1 - on_bad))
        score = score + F.when(F.col(name) == -1, against).when(F.col(name) == 1, for_it).otherwise(0.0)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def fit(patterns: DataFrame, names: list[str], rounds: int = ROUNDS) -> tuple[dict[str, tuple[float, float]], float]:
    """How often each rule is right on good and on bad documents, and the share of good ones.

    Takes vote patterns and their counts `n`. Expectation and maximisation of a round are one aggregate over the
    patterns; a row of sums comes back. Estimates are rounded to nine digits, so that the order of additions does not
    matter.
    """

    def estimate(right: float, votes: float, start: float, limits: tuple[float, float]) -> float:
        return round(min(max((right + SMOOTHING * start) / (votes + SMOOTHING), limits[0]), limits[1]), 9)

    model, good = dict.fromkeys(names, (START_ON_GOOD, START_ON_BAD)), START_GOOD
    for _ in range(rounds):
        p, n = F.col("p"), F.col("n")
        sums = [F.sum(n * p).alias("good"), F.sum("n").alias("all")]
        for r in names:
            up, down = F.when(F.col(r) == 1, n).otherwise(0), F.when(F.col(r) == -1, n).otherwise(0)
            sums += [F.sum(up * p).alias(f"{r}_gu"), F.sum(down * p).alias(f"{r}_gd"), F.sum(up * (1 - p)).alias(f"{r}_bu"), F.sum(down * (1 - p)).alias(f"{r}_bd")]
        row = patterns.withColumn("p", _posterior(model, good)).agg(*sums).first()
        if not row["all"]:
            break
        old = dict(model), good
        for r in names:
            gu, gd, bu, bd = (row[f"{r}_{k}"] for k in ("gu", "gd", "bu", "bd"))
            model[r] = estimate(gu, gu + gd, START_ON_GOOD, ON_GOOD), estimate(bd, bu + bd, START_ON_BAD, ON_BAD)
        good = estimate(row["good"], row["all"], START_GOOD, GOOD)
        if (model, good) == old:
            break
    return model, good


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """Counts, votes, posterior quality and verdict of every document.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, a vote per rule, p_good, base_failed,
    kept. A null or empty text has no words and fails the base rules. Every row is judged by itself, repeated and null
    ids included; repeated texts count as often as they occur. An empty table gives no rows. Other columns are ignored.
    """
    rules = votes()
    names = list(rules)
    counted = base_counts(docs, doc_id, text)
    counted = counted.select("*", *[c.alias(n) for n, c in rules.items()])
    narrow = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    # Counts only: texts are read once.
    counted = stored_table(counted.select(*narrow, *names), "votes")
    patterns = stored_table(counted.groupBy(*names).agg(F.count("*").alias("n")), "patterns")
    model, good = fit(patterns, names)
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)
    judged = counted.withColumn("p_good", _posterior(model, good)).withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= least))

"""Which names of a dictionary occur in texts as whole words, whatever the number of names.

Texts are cut into runs of words of the lengths that names have, and these meet the names in one equality join, so the
work follows the texts and not texts times names. The join is Spark's to choose: a small dictionary is broadcast, a large
one is shuffled, and a very frequent run is a hot key against a single row per name, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidex.operators.validators import run_bool_validator

MAX_WORDS = 16
# Fixed values (a whole word is bounded by anything but these, as in `mentions_any`).
WORD, OTHER = "[a-z0-9]+", "[^a-z0-9]"


def _names(names: DataFrame, name: str) -> DataFrame:
    """Distinct lower-cased names: name, core (first to last word), prefix, suffix (signs around it), n_words."""
    low = names.select(F.lower(name).alias("name")).filter(F.col("name").rlike("[a-z0-9]")).distinct()
    return low.select(
        "name",
        F.regexp_extract("name", "(?s)[a-z0-9](?:.*[a-z0-9])?", 0).alias("core"),
        F.regexp_extract("name", f"^{OTHER}*", 0).alias("prefix"),
        F.regexp_extract("name", f"{OTHER}*$", 0).alias("suffix"),
        F.size(F.regexp_extract_all("name", F.lit(WORD), 0)).alias("n_words"),
    )


def _runs(parts: Column, lengths: list[int]) -> Column:
    """All runs of words of `parts` (words and what lies between them, in turn) as structs with their surroundings."""
    first = F.when(parts[0].rlike("[a-z0-9]"), F.lit(1)).otherwise(F.lit(2))

    def of_length(m: int) -> Column:
        width = 2 * m - 1
        last = F.size(parts) - width + 1

        def run(p: Column) -> Column:
            core = parts[p - 1] if m == 1 else F.array_join(F.slice(parts, p, width), "")
            before = F.when(p > 1, parts[F.greatest(p - 2, F.lit(0))]).otherwise("")
            after = F.when(p < last, parts[F.least(p - 1 + width, F.size(parts) - 1)]).otherwise("")
            begins, ends = p == first, p + 1 >= last
            return F.struct(core.alias("core"), before.alias("before"), after.alias("after"), begins.alias("begins"), ends.alias("ends"))

        places = F.when(last >= first, F.sequence(first, last, F.lit(2))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, run)

    return F.concat(*[of_length(m) for m in lengths])


def _cores(parts: Column, lengths: list[int]) -> Column:
    """The distinct runs of words of `parts`, without their surroundings."""
    first = F.when(parts[0].rlike("[a-z0-9]"), F.lit(1)).otherwise(F.lit(2))

    def of_length(m: int) -> Column:
        width = 2 * m - 1
        last = F.size(parts) - width + 1
        places = F.when(last >= first, F.sequence(first, last, F.lit(2))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda p: F.concat(*[parts[p - 1 + i] for i in range(width)]))

    return F.array_distinct(F.concat(*[of_length(m) for m in lengths]))


def name_mentions(texts: DataFrame, names: DataFrame, id_col: str, text: str, name: str = "name") -> DataFrame:
    """(id_col, name): which names occur in which rows' texts, whatever their case; one row per id and name.

    A name must stand between signs, blanks or the ends of the text, its own signs and blanks count, and names without
    a letter a-z or digit are never found. Null texts and names are no texts and names. A name of more than
    `MAX_WORDS` words is an error.
    """
    known = _names(names, name)
    known = known.withColumn("signed", (F.col("prefix") != "") | (F.col("suffix") != ""))
    # At most MAX_WORDS + 1 numbers, with and without signs.
    found = known.select("signed", F.least("n_words", F.lit(MAX_WORDS + 1)).alias("n")).distinct().collect()
    if any(r.n > MAX_WORDS for r in found):
        raise ValueError(f"a name has more than {MAX_WORDS} words")
    plain, signed = (sorted(r.n for r in found if r.signed == s) for s in (False, True))
    if not found:
        return texts.select(id_col, F.lit("").alias("name")).limit(0)
    parts = F.regexp_extract_all(F.lower(text), F.lit(f"{WORD}|{OTHER}+"), 0)
    # Any text but an empty one has parts; asked of the parts themselves, they would be made twice.
    cut = texts.filter(F.length(text) > 0).select(F.col(id_col).alias("_id"), parts.alias("_parts"))
    met = []
    if plain:
        # A name without signs needs no surroundings, and what a text repeats is sent once.
        cores = cut.select("_id", F.explode(_cores(F.col("_parts"), plain)).alias("core"))
        met.append(cores.join(known.filter(~F.col("signed")).select("core", "name"), "core").select("_id", "name"))
    if signed:
        runs = cut.select("_id", F.explode(_runs(F.col("_parts"), signed)).alias("r")).select("_id", "r.*")
        beside = runs.join(known.filter("signed"), "core")
        # Signs of the name itself must be there, and before them no word may end (or after them begin) at once.
        ahead = F.col("before").endswith(F.col("prefix")) & (F.col("begins") | (F.length("before") > F.length("prefix")))
        behind = F.col("after").startswith(F.col("suffix")) & (F.col("ends") | (F.length("after") > F.length("suffix")))
        whole = ((F.col("prefix") == "") | ahead) & ((F.col("suffix") == "") | behind)
        met.append(beside.filter(whole).select("_id", "name"))
    mentions = met[0].union(met[1]) if len(met) > 1 else met[0]
    return mentions.select(F.col("_id").alias(id_col), "name").distinct()


def name_match(df: DataFrame, names: DataFrame, text: str, rule_id: str, id_col: str, name: str = "name", **due) -> DataFrame:
    """Does a row's text mention a name of the dictionary? Rows of a validator; NULL for a row without text."""

    def check(rows: DataFrame) -> DataFrame:
        found = name_mentions(rows.filter("item_id is not null"), names, "item_id", text, name)
        found = found.select("item_id", F.lit(True).alias("_hit")).distinct()
        hit = F.when(F.col(text).isNotNull(), F.coalesce("_hit", F.lit(False)))
        return rows.join(found, "item_id", "left").withColumn("result", hit)

    return run_bool_validator(df, rule_id, id_col, check, **due)

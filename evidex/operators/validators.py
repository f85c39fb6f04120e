"""Checks over sampled items, their coverage and their roll-up."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidex.functions.scalars import SEED, as_column, first_number
from evidex.operators.sampling import cap_per_key, hash_sample

# Fixed values (defaults the results depend on).
MAX_CHECKS_PER_ITEM = 5
TOLERANCE = 0.02
SAMPLE_FRAC = 0.25

Check = Column | Callable[[DataFrame], DataFrame]


def checks_due(
    df: DataFrame,
    rule_id: str,
    id_col: str,
    done: DataFrame | None = None,
    sample_frac: float | None = None,
    cap: int | None = MAX_CHECKS_PER_ITEM,
    tiebreak: Sequence[str] = (),
    seed: int = SEED,
) -> DataFrame:
    """Rows still to be checked, with `item_id` and `rule_id`: sampled by id, capped per id, not in `done`.

    The cap trims a repeated id inside each map task before the one shuffle; the anti join then finds its
    rows already placed by item_id. `cap=None` saves that shuffle for a table with unique ids.
    """
    due = hash_sample(df, id_col, sample_frac, seed).withColumn("item_id", F.col(id_col).cast("string"))
    if cap is not None:
        due = cap_per_key(due, "item_id", cap, tiebreak, seed, "_rank").drop("_rank")
    if done is not None:
        checked = done.filter(F.col("rule_id") == rule_id).select("item_id")
        due = due.join(checked, "item_id", "left_anti")
    return due.withColumn("rule_id", F.lit(rule_id))


def _with_result(due: DataFrame, check: Check) -> DataFrame:
    return due.withColumn("result", check) if isinstance(check, Column) else check(due)


def run_bool_validator(df: DataFrame, rule_id: str, id_col: str, check: Check, **due) -> DataFrame:
    """(item_id, rule_id, result_bool, score, note). `check` is a boolean column or adds a column `result`."""
    made = _with_result(checks_due(df, rule_id, id_col, **due), check)
    return made.select(
        "item_id",
        "rule_id",
        F.col("result").cast("boolean").alias("result_bool"),
        F.lit(None).cast("double").alias("score"),
        F.lit(None).cast("string").alias("note"),
    )


def within_tolerance(value: Column, reference: Column, frac: float, signed: bool = False) -> Column:
    """|value - reference| <= frac * |reference|; `signed` keeps the sign, so negative references never pass."""
    return F.abs(value - reference) <= F.lit(frac) * (reference if signed else F.abs(reference))


def run_tolerance_validator(
    df: DataFrame,
    rule_id: str,
    id_col: str,
    check: Check,
    reference: Column | str,
    tolerance: float = TOLERANCE,
    signed: bool = False,
    **due,
) -> DataFrame:
    """Like the boolean form for a number: `check` yields the number once, it is stored as the score."""
    made = _with_result(checks_due(df, rule_id, id_col, **due), check)
    return made.select(
        "item_id",
        "rule_id",
        within_tolerance(F.col("result"), as_column(reference), tolerance, signed).alias("result_bool"),
        F.col("result").cast("double").alias("score"),
        F.lit(f"tolerance={tolerance}").alias("note"),
    )


def mentions_any(text: Column | str, words: Sequence[str]) -> Column:
    """True when the text has one of the words as a whole word, whatever their case."""
    quoted = "|".join("".join(c if c.isalnum() else "\\" + c for c in w.lower()) for w in words)
    return F.lower(as_column(text)).rlike(rf"(^|[^a-z0-9])({quoted})([^a-z0-9]|$)")


def brand_model_match(
    image_desc: DataFrame, words: Sequence[str], rule_id: str = "rule_brand_model", id_col: str = "image_id", **due
) -> DataFrame:
    """Does the caption mention an expected brand or model word?"""
    return run_bool_validator(image_desc, rule_id, id_col, mentions_any("caption", words), **due)


def table_vs_text_total(
    facts: DataFrame, rule_id: str = "rule_table_text_total", tolerance: float = TOLERANCE, **due
) -> DataFrame:
    """Does the number written in a fact's text agree with the fact's number?"""
    check = first_number("object_value")
    return run_tolerance_validator(facts, rule_id, "fact_id", check, "object_number", tolerance, **due)


def validator_coverage(results: DataFrame) -> DataFrame:
    """(rule_id, n, pass_rate) per rule."""
    return results.groupBy("rule_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("result_bool").cast("int")).alias("pass_rate")
    )


def rule_outcomes(results: DataFrame) -> DataFrame:
    """(name, result, note) per rule: passed only if every known result passed; all unknown stays NULL.

    Rows are first reduced per rule and note, with a hash aggregate; a smallest string over all rows would make
    Spark sort them.
    """
    per_note = results.groupBy(F.col("rule_id").alias("name"), "note").agg(F.bool_and("result_bool").alias("result"))
    return per_note.groupBy("name").agg(F.bool_and("result").alias("result"), F.min("note").alias("note"))


def validator_rollup(results: DataFrame) -> DataFrame:
    """One row with all rule outcomes as an array of structs, sorted by rule; NULL without any rule."""
    items = F.array_sort(F.collect_list(F.struct("name", "result", "note")))
    return rule_outcomes(results).agg(items.alias("items")).select(
        F.when(F.size("items") > 0, F.col("items")).alias("validators")
    )

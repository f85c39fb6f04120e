"""Typed facts from text chunks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidex.functions.scalars import (
    ISO_DATE_PATTERN,
    NUMBER_PATTERN,
    compute_once,
    first_match,
    safe_date,
    stable_id,
)
from evidex.operators.chunks import pending

# Fixed values (defaults the results depend on).
MIN_CONFIDENCE = 0.65
FACT_SCHEMA = (
    "entity string, predicate string, value_text string, value_number double, "
    "value_date string, confidence double, source_span string"
)
ENTITY_PATTERN = r"\p{Lu}[\p{L}\p{N}]*"


def rule_facts(
    text: str = "text",
    entity: str = ENTITY_PATTERN,
    number: str = NUMBER_PATTERN,
    date: str = ISO_DATE_PATTERN,
    entity_group: int = 0,
    number_group: int = 0,
) -> Callable[[DataFrame], DataFrame]:
    """Built-in model: the first entity, number and date of the whole text, found by patterns.

    Confidence is 0.5 for an entity, plus 0.3 for a number and 0.2 for a date. Each pattern is matched once per row.
    """

    def model(df: DataFrame) -> DataFrame:
        found = compute_once(
            df,
            _entity=first_match(text, entity, entity_group),
            _value=first_match(text, number, number_group),
            _day=first_match(text, date),
        )
        has_value, has_day = F.col("_value").isNotNull(), F.col("_day").isNotNull()
        tenths = (
            F.when(F.col("_entity").isNotNull(), 5).otherwise(0)
            + F.when(has_value, 3).otherwise(0)
            + F.when(has_day, 2).otherwise(0)
        )
        out = F.struct(
            F.col("_entity").alias("entity"),
            F.when(has_value, "has_value").when(has_day, "has_date").otherwise("mentioned").alias("predicate"),
            F.coalesce("_value", "_day").alias("value_text"),
            F.col("_value").try_cast("double").alias("value_number"),
            F.col("_day").alias("value_date"),
            (tenths / F.lit(10.0)).alias("confidence"),
            F.lit(None).cast("string").alias("source_span"),
        )
        return found.withColumn("out", out)

    return model


def ask_facts(chunks: DataFrame, model: Column | Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The chunks with the model's answer in the struct `out`.

    `model` is a struct column, or a function that adds the struct to the chunk table (see `generate_table` with
    FACT_SCHEMA).
    """
    if model is None:
        model = rule_facts()
    return compute_once(chunks, out=model) if isinstance(model, Column) else model(chunks)


def answered(made: DataFrame) -> DataFrame:
    """The rows a model did not fail on; a row without a usable fact is answered too."""
    return made.filter("out_error is null") if "out_error" in made.columns else made


def usable_facts(made: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Facts of answered chunks (with `fact_id` and `out`) that are confident enough and have a subject."""
    return made.select(
        "fact_id",
        F.col("out.entity").alias("subject"),
        F.col("out.predicate").alias("predicate"),
        F.col("out.value_text").alias("object_value"),
        F.col("out.value_number").alias("object_number"),
        safe_date(F.col("out.value_date")).alias("object_date"),
        "source_uri",
        F.col("span").alias("source_span"),
        F.col("out.confidence").alias("confidence"),
    ).filter((F.col("confidence") >= min_confidence) & F.col("subject").isNotNull())


def fact_id(key: str = "chunk") -> Column:
    """`span`: uri#start-end; `chunk`: from the chunk id, which cannot collide for two chunks of one source."""
    if key == "span":
        start, end = F.col("span.offset_start").cast("string"), F.col("span.offset_end").cast("string")
        return F.concat(F.col("source_uri"), F.lit("#"), start, F.lit("-"), end)
    return stable_id("chunk_id", F.lit("#fact"))


def extract_facts(
    chunks: DataFrame,
    model: Column | Callable[[DataFrame], DataFrame] | None = None,
    done: DataFrame | None = None,
    min_confidence: float = MIN_CONFIDENCE,
    key: str = "chunk",
) -> DataFrame:
    """One fact per chunk, kept when its confidence reaches `min_confidence` and it has a subject.

    Facts in `done` are not asked for again. `model` is as for `ask_facts`, `key` as for `fact_id`.
    """
    todo = chunks.withColumn("fact_id", fact_id(key))
    if done is not None:
        todo = pending(todo, done, "fact_id")
    return usable_facts(ask_facts(todo, model), min_confidence)

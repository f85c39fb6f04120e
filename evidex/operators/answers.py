"""Cited answers from retrieved context."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidex.functions.json import json_value, json_variant
from evidex.functions.scalars import (
    SNIPPET_CHARS,
    ab_variant,
    clamp01,
    compute_once,
    keep_allowed,
    null_if_empty,
    snippet,
    stable_id,
)
from evidex.functions.tokens import tokens
from evidex.operators.groups import topk_per_group
from evidex.operators.retrieval import CONTEXT_K

# Fixed values (defaults the results depend on).
ANSWER_SCHEMA = (
    "summary string, citations array<string>, confidence double, "
    "validators array<struct<name: string, result: boolean, note: string>>"
)
CONTEXT_SEPARATOR = "\n- "
NO_VALIDATORS = "array<struct<name: string, result: boolean, note: string>>"


def answer_inputs(
    questions: DataFrame, contexts: DataFrame, k: int = CONTEXT_K, chars: int = SNIPPET_CHARS
) -> DataFrame:
    """(query_id, query, contexts, context_text, allowed_uris, allowed_sources), one row per question.

    At most k texts per question are gathered, each whole for the built-in rule and as a snippet for a model.
    """
    order = [F.col("rank"), F.col("source_uri")]
    best = topk_per_group(contexts.select("query_id", "source_uri", "text", "rank"), ["query_id"], order, k, "slot")
    item = F.struct(F.col("slot").alias("rank"), "source_uri", snippet("text", chars).alias("snippet"), "text")
    gathered = best.groupBy("query_id").agg(F.array_sort(F.collect_list(item)).alias("contexts"))
    rows = questions.select("query_id", "query").join(gathered, "query_id", "left")
    uris = F.array_sort(F.array_distinct(F.transform("contexts", lambda c: c["source_uri"])))
    return compute_once(
        rows,
        context_text=F.array_join(F.transform("contexts", lambda c: c["snippet"]), CONTEXT_SEPARATOR),
        allowed_uris=null_if_empty(uris),
    ).withColumn("allowed_sources", F.concat(F.lit("Allowed sources: "), F.array_join("allowed_uris", ", ")))


def passages(text: Column, chars: int = SNIPPET_CHARS) -> Column:
    """The whole text in pieces of `chars` characters, line ends as blanks."""
    flat = F.regexp_replace(text, "[\n\r]", " ")
    starts = F.sequence(F.lit(0), F.floor((F.greatest(F.length(flat), F.lit(1)) - 1) / chars).cast("int"))
    return F.transform(starts, lambda i: F.substring(flat, i * chars + 1, F.lit(chars)))


def extractive_answer(inputs: DataFrame, chars: int = SNIPPET_CHARS) -> DataFrame:
    """Built-in model: quote the passage that shares most words with the question, cite all texts with one as good.

    Whole texts are searched; each source stands with its best passage, the first of equals. Confidence is the share
    of the question's words found in the quoted passage.
    """
    df = compute_once(inputs, _words=F.array_distinct(tokens("query")))

    def best_of(c: Column) -> Column:
        rated = F.transform(
            passages(c["text"], chars),
            lambda p, i: F.struct(
                (-F.size(F.array_intersect(F.col("_words"), tokens(p)))).alias("missing_rank"), i.alias("place"), p.alias("snippet")
            ),
        )
        return F.array_min(rated)

    rated = F.transform("contexts", lambda c: F.struct(best_of(c).alias("best"), c["rank"].alias("rank"), c["source_uri"].alias("source_uri")))
    scored = F.array_sort(
        F.transform(
            rated,
            lambda r: F.struct(
                r["best"]["missing_rank"].alias("missing_rank"), r["rank"].alias("rank"), r["source_uri"].alias("source_uri"), r["best"]["snippet"].alias("snippet")
            ),
        )
    )
    df = compute_once(df, _scored=scored)
    best = F.try_element_at("_scored", F.lit(1))
    shared = best["missing_rank"]
    cited = F.filter("_scored", lambda s: (s["missing_rank"] == shared) & (s["missing_rank"] < 0))
    share = F.try_divide((-shared).cast("double"), F.size("_words").cast("double"))
    out = F.struct(
        F.when(shared < 0, best["snippet"]).alias("summary"),
        F.transform(cited, lambda s: s["source_uri"]).alias("citations"),
        F.when(shared < 0, share).when(F.col("contexts").isNotNull(), F.lit(0.0)).alias("confidence"),
        F.lit(None).cast(NO_VALIDATORS).alias("validators"),
    )
    return df.withColumn("out", out)


def synthesize_answers(
    questions: DataFrame,
    contexts: DataFrame,
    model: Column | Callable[[DataFrame], DataFrame] | None = None,
    rollup: DataFrame | None = None,
    k: int = CONTEXT_K,
    split_frac: float = 0.5,
    chars: int = SNIPPET_CHARS,
) -> DataFrame:
    """(answer_id, query_id, query, prompt_version, summary, citations, validators, confidence) per question.

    Citations are cut to the sources of the question's own context, whatever the model returns. `rollup` is
    the one-row table of `validator_rollup`; without it the model's own validators are kept. The variant
    picked by the hash of the question is a column the model can read to choose its instruction.
    """
    inputs = answer_inputs(questions, contexts, k, chars).withColumn("prompt_version", ab_variant("query", split_frac))
    if rollup is not None:
        inputs = inputs.withColumn("rules", rollup.select("validators").scalar())
        inputs = inputs.withColumn("validators_summary", F.to_json("rules"))
    if model is None:
        made = extractive_answer(inputs, chars)
    else:
        made = inputs.withColumn("out", model) if isinstance(model, Column) else model(inputs)
    allowed = F.coalesce("allowed_uris", F.array().cast("array<string>"))
    return made.select(
        stable_id("query_id", F.lit("|"), "prompt_version", F.lit("|"), "query").alias("answer_id"),
        "query_id",
        "query",
        "prompt_version",
        F.coalesce("out.summary", F.lit("")).alias("summary"),
        F.coalesce(keep_allowed(F.col("out.citations"), allowed), F.array().cast("array<string>")).alias("citations"),
        F.col("rules" if rollup is not None else "out.validators").alias("validators"),
        clamp01("out.confidence").alias("confidence"),
    )


def answer_cards(answers: DataFrame) -> DataFrame:
    """Answers with the number of their citations instead of the list."""
    rest = [c for c in ("confidence", "created_ts") if c in answers.columns]
    return answers.select("answer_id", "query", "summary", F.size("citations").alias("num_citations"), *rest)


def answer_rules(answers: DataFrame) -> DataFrame:
    """(answer_id, validators_summary, n_rules, failed): the checks of each answer as JSON, and what a reader takes from it.

    The counts are read back out of the JSON, as by a client that only gets the text.
    """
    made = answers.select("answer_id", F.to_json("validators").alias("validators_summary"))
    checks = json_value(json_variant("validators_summary"), "$", "array<struct<name: string, result: boolean, note: string>>")
    made = compute_once(made, _checks=checks)
    failed = F.transform(F.filter("_checks", lambda c: c["result"] == F.lit(False)), lambda c: c["name"])
    return made.select("answer_id", "validators_summary", F.size("_checks").alias("n_rules"), F.array_join(failed, ", ").alias("failed"))


def latest_answer(answers: DataFrame, n: int = 1) -> DataFrame:
    """The newest answers, ties by id, with their citations in one line."""
    return (
        answers.orderBy(F.desc("created_ts"), "answer_id").limit(n)
        .select(
            "query", "summary", F.array_join("citations", ", ").alias("cites"),
            F.size("citations").alias("n_citations"), F.round("confidence", 3).alias("confidence"), "created_ts",
        )
    )

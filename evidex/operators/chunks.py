"""Text chunks: one chunk per object and text kind, keyed by a hash of its source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidex.functions.scalars import as_column, compute_once, first_match, stable_id

# Fixed values (chunk ids are the hash of the source and one of these endings).
PDF_SUFFIX = "#pdf"
SCREEN_SUFFIX = "#screen"
IMAGE_SUFFIX = "#img"
CAPTION_SUFFIX = "#cap"

# Fixed values (page markup that is no text).
HIDDEN_HTML = r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->"
ANY_TAG = r"(?s)<[^>]*>"
TITLE = r"(?is)<title>(.*?)</title>"


def html_text(html: Column | str) -> Column:
    """Visible text of a page: scripts, styles, comments and tags go, runs of blanks become one."""
    c = F.regexp_replace(as_column(html), HIDDEN_HTML, " ")
    c = F.regexp_replace(c, ANY_TAG, " ")
    return F.trim(F.regexp_replace(c, "[ \t\r\n]+", " "))


def html_title(html: Column | str) -> Column:
    return first_match(html, TITLE, 1)


def extract_chunks(
    objects: DataFrame,
    suffix: str,
    source_uri: str = "object_uri",
    text: Column | str = "text",
    lang: Column | str | None = None,
    extractor: Callable[[DataFrame], DataFrame] | None = None,
    done: DataFrame | None = None,
) -> DataFrame:
    """(chunk_id, source_uri, text, lang, span) with the whole text of an object as one chunk.

    `extractor` turns the object table into one with a text column first (a model run by `generate_table`,
    for instance); objects without text give no chunk. Objects whose chunk is in `done` are left out before
    their text is extracted.
    """
    df = objects.withColumn("chunk_id", F.sha2(F.concat(F.col(source_uri), F.lit(suffix)), 256))
    if done is not None:
        df = pending(df, done, "chunk_id")
    df = extractor(df) if extractor else df
    if isinstance(text, Column):
        df, text = compute_once(df, _text=text), "_text"
    body = F.col(text)
    df = df.select(
        "chunk_id",
        F.col(source_uri).alias("source_uri"),
        body.alias("text"),
        (as_column(lang) if lang is not None else F.lit(None)).cast("string").alias("lang"),
    ).filter(F.col("text").isNotNull() & (F.length("text") > 0))
    return df.withColumn(
        "span",
        F.struct(
            F.lit(0).cast("bigint").alias("offset_start"),
            F.length("text").cast("bigint").alias("offset_end"),
        ),
    )


def chunks_from_captions(image_desc: DataFrame) -> DataFrame:
    """Captions become chunks of their image."""
    return extract_chunks(image_desc, CAPTION_SUFFIX, "source_uri", "caption")


def pending(source: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    """Rows of `source` whose key is not in `done`; a key with a NULL is never done.

    One anti join, so the source is evaluated once. Spark broadcasts the known keys or shuffles both sides by their size.
    """
    return source.join(done.select(*keys), list(keys), "left_anti")


def call_id(prompt_id: str, version: Column, key: str) -> Column:
    """Id of one model call: the same prompt, version and row always give the same id."""
    return stable_id(F.lit(prompt_id), F.lit("|"), version, F.lit("|"), F.col(key))


def prompt_log(
    work: DataFrame, prompt_id: str, prompt_version: Column | str, model_id: str, input_text: Column | str, key: str
) -> DataFrame:
    """One log row per model call, taken from the same pending rows that are sent to the model."""
    version = F.lit(prompt_version) if isinstance(prompt_version, str) else prompt_version
    return work.select(
        call_id(prompt_id, version, key).alias("call_id"),
        F.lit(prompt_id).alias("prompt_id"),
        version.alias("prompt_version"),
        F.lit(model_id).alias("model_id"),
        F.sha2(as_column(input_text).cast("string"), 256).alias("input_hash"),
    )

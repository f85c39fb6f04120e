"""Context for questions and the quality of retrieval."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidex.functions.scalars import predicate
from evidex.operators.groups import topk_per_group
from evidex.operators.vectors import SEARCH_K, search

# Fixed values (defaults the results depend on).
CONTEXT_K = 12
HOLDOUT_SIZE = 200


def retrieval_metrics(preds: DataFrame, truth: DataFrame, k: int = SEARCH_K, few_queries: bool = False) -> DataFrame:
    """(query_id, k, recall_k, precision_k, mrr), one row per query that has a truth.

    preds: (query_id, item_id, rank); truth: (query_id, item_id). `few_queries` says that the caller has
    checked the number of queries, so that the preds (k per query) may be broadcast to the truth.
    """
    hits = preds.filter(F.col("rank") <= k).select("query_id", "item_id", "rank")
    if few_queries:
        hits = F.broadcast(hits)
    per_query = (
        truth.select("query_id", "item_id")
        .join(hits, ["query_id", "item_id"], "left")
        .groupBy("query_id")
        .agg(
            F.count(F.lit(1)).alias("truth_n"),
            F.count("rank").alias("hits"),
            F.min("rank").alias("best"),
        )
    )
    return per_query.select(
        "query_id",
        F.lit(k).cast("bigint").alias("k"),
        F.try_divide(F.col("hits").cast("double"), F.col("truth_n").cast("double")).alias("recall_k"),
        F.try_divide(F.col("hits").cast("double"), F.lit(float(k))).alias("precision_k"),
        F.coalesce(F.try_divide(F.lit(1.0), F.col("best").cast("double")), F.lit(0.0)).alias("mrr"),
    )


def retrieval_eval(
    base: DataFrame,
    queries: DataFrame,
    truth: DataFrame,
    k: int = SEARCH_K,
    item_id: str = "item_id",
    query_id: str = "query_id",
    vector: str = "vector",
    query_vector: str = "vector",
    **limits: int,
) -> DataFrame:
    """Search all queries at once and measure the hits against the truth."""
    hits, few = search(base, queries, k, item_id, query_id, vector, query_vector, **limits)
    return retrieval_metrics(hits, truth, k, few)


def retrieval_metrics_mean(metrics: DataFrame) -> DataFrame:
    """Mean recall, precision and reciprocal rank per k."""
    return metrics.groupBy("k").agg(*[F.avg(c).alias(c) for c in ("recall_k", "precision_k", "mrr")])


def make_holdout(
    chunks: DataFrame,
    embeddings: DataFrame,
    n: int = HOLDOUT_SIZE,
    embedder: Callable[[DataFrame, str, str], DataFrame] | None = None,
) -> DataFrame:
    """(query_id, query_text, vector, item_id): the first n chunks as queries, each with itself as truth.

    Ids, texts and truth come from the same n rows, found as a distributed top-n before they are numbered.
    A chunk without a stored vector is embedded by `embedder`.
    """
    first = chunks.select("chunk_id", "text").orderBy("chunk_id").limit(n)
    numbered = first.withColumn("n", F.row_number().over(Window.orderBy("chunk_id")))
    known = embeddings.join(F.broadcast(first.select("chunk_id")), "chunk_id").select("chunk_id", "vector")
    rows = numbered.join(known, "chunk_id", "left")
    if embedder is not None:
        fresh = embedder(rows.filter(F.col("vector").isNull()).select("chunk_id", "text"), "chunk_id", "text")
        fresh = fresh.select("chunk_id", F.col("vector").alias("fresh"))
        rows = rows.join(fresh, "chunk_id", "left").withColumn("vector", F.coalesce("vector", "fresh"))
    return rows.select(
        F.concat(F.lit("hq_"), F.col("n").cast("string")).alias("query_id"),
        F.col("text").alias("query_text"),
        "vector",
        F.col("chunk_id").alias("item_id"),
    )


def retrieve_context(
    questions: DataFrame,
    embeddings: DataFrame,
    chunks: DataFrame,
    k: int = CONTEXT_K,
    constraints=(),
    **limits,
) -> DataFrame:
    """(query_id, source_uri, text, distance, rank) of the k nearest chunks of every question.

    questions: (query_id, vector); embeddings: (chunk_id, vector); chunks: (chunk_id, source_uri, text).
    `constraints` filter the k hits by query_id, item_id, distance or rank.
    """
    hits, few = search(embeddings, questions, k, "chunk_id", "query_id", "vector", "vector", **limits)
    hits = hits.filter(predicate(constraints)).withColumnRenamed("item_id", "chunk_id")
    if few:
        # At most k hits for each of a checked number of questions.
        hits = F.broadcast(hits)
    return chunks.select("chunk_id", "source_uri", "text").join(hits, "chunk_id").select(
        "query_id", "source_uri", "text", "distance", "rank"
    )


def context_with_fallback(
    questions: DataFrame, primary: DataFrame, captions: DataFrame, k: int = CONTEXT_K, recency: str = "created_ts"
) -> DataFrame:
    """Exactly the primary context, filled up to k rows with the most recent captions.

    primary: (query_id, source_uri, text, rank); captions: (source_uri, caption, recency). Each free place of
    a question is matched with the caption of that number, so the k captions are the only broadcast.
    """
    recent = (
        captions.filter(F.col("caption").isNotNull())
        .orderBy(F.desc(recency), "source_uri")
        .limit(k)
        .select("source_uri", F.col("caption").alias("text"), F.row_number().over(
            Window.orderBy(F.desc(recency), "source_uri")).alias("place"))
    )
    order = [F.col("rank"), F.col("source_uri")]
    first = topk_per_group(primary.select("query_id", "source_uri", "text", "rank"), ["query_id"], order, k, "slot")
    held = first.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("slot", "source_uri", "text"))).alias("held"))
    rows = questions.select("query_id").join(held, "query_id", "left")
    n = F.when(F.col("held").isNull(), 0).otherwise(F.size("held"))
    own = F.transform(
        F.coalesce("held", F.array().cast("array<struct<slot: int, source_uri: string, text: string>>")),
        lambda c: F.struct(c["slot"].alias("rank"), F.lit(0).alias("place"), c["source_uri"].alias("own_uri"), c["text"].alias("own_text")),
    )
    free = F.transform(
        F.when(n < k, F.sequence(F.lit(1), F.lit(k) - n)).otherwise(F.array().cast("array<int>")),
        lambda p: F.struct(
            (n + p).alias("rank"), p.alias("place"),
            F.lit(None).cast("string").alias("own_uri"), F.lit(None).cast("string").alias("own_text"),
        ),
    )
    slots = rows.select("query_id", F.inline(F.concat(own, free)))
    is_primary = F.col("place") == 0
    return (
        slots.join(F.broadcast(recent), "place", "left")
        .filter(is_primary | F.col("text").isNotNull())
        .select(
            "query_id",
            F.when(is_primary, F.col("own_uri")).otherwise(F.col("source_uri")).alias("source_uri"),
            F.when(is_primary, F.col("own_text")).otherwise(F.col("text")).alias("text"),
            "rank",
            is_primary.alias("is_primary"),
        )
    )

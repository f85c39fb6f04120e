"""Stored neighbours and edges of the frequent queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidex.functions.scalars import HYBRID_WEIGHTS, hybrid_score, stable_id
from evidex.operators.vectors import NEIGHBOR_K, SEARCH_K, vector_topk

EDGE_KEYS = ["left_id", "right_id", "left_type", "right_type"]


def neighbors_of(hits: DataFrame, k: int = NEIGHBOR_K, neighbor_type: str = "text") -> DataFrame:
    """(query_id, neighbor_id, neighbor_type, similarity) from search hits of at least k per query."""
    return hits.filter(F.col("rank") <= k).select(
        F.col("query_id").cast("string").alias("query_id"),
        F.col("item_id").cast("string").alias("neighbor_id"),
        F.lit(neighbor_type).alias("neighbor_type"),
        (F.lit(1.0) - F.col("distance")).alias("similarity"),
    )


def precompute_neighbors(base: DataFrame, hot_queries: DataFrame, k: int = NEIGHBOR_K, **columns) -> DataFrame:
    """Neighbours of all hot queries in one search."""
    return neighbors_of(vector_topk(base, hot_queries, k, **columns), k)


def edges_of(hits: DataFrame, k: int = SEARCH_K) -> DataFrame:
    """Edges query → neighbour, keyed by both ends and their types; write them with `upsert`."""
    edges = neighbors_of(hits, k).select(
        F.col("query_id").alias("left_id"),
        F.col("neighbor_id").alias("right_id"),
        F.lit("text").alias("left_type"),
        F.col("neighbor_type").alias("right_type"),
        "similarity",
        F.lit(True).alias("constraints_ok"),
        F.lit(None).cast("string").alias("constraint_notes"),
    )
    bar = F.lit("|")
    return edges.withColumn("edge_id", stable_id("left_id", bar, "right_id", bar, "left_type", bar, "right_type"))


def semantic_edges(base: DataFrame, hot_queries: DataFrame, k: int = SEARCH_K, **columns) -> DataFrame:
    """Edges of all hot queries in one search."""
    return edges_of(vector_topk(base, hot_queries, k, **columns), k)


def hybrid_top(edges: DataFrame, n: int = 100, weights=HYBRID_WEIGHTS, digits: int = 9) -> DataFrame:
    """The n best edges by hybrid score, ties by edge id."""
    scored = edges.withColumn("hybrid_score", F.round(hybrid_score(weights=weights), digits))
    return scored.orderBy(F.desc("hybrid_score"), "edge_id").limit(n)


def hybrid_preview(edges: DataFrame, n: int = 10, weights=HYBRID_WEIGHTS) -> DataFrame:
    """The few best edges with the two further score parts shown."""
    return hybrid_top(edges, n, weights).withColumns(
        {"recency_score": F.lit(0.0), "validator_pass_rate": F.lit(0.0)}
    )

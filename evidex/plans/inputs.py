"""How the given tables play the parts of the evidence tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidex.functions.scalars import NUMBER_PATTERN
from evidex.operators.chunks import (
    IMAGE_SUFFIX,
    PDF_SUFFIX,
    SCREEN_SUFFIX,
    extract_chunks,
    html_text,
    html_title,
)
from evidex.operators.embed import hashed_embedding
from evidex.operators.facts import extract_facts, rule_facts
from evidex.operators.kpi import kpi_daily_counts
from evidex.operators.vectors import mean_vectors
from evidex.session import fill_cores, use_utc

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def document_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    uri = F.concat(F.lit("doc://"), "source", F.lit("/"), F.col("doc_id").cast("string"))
    return docs.withColumn("object_uri", uri)


def document_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_chunks(document_objects(spark, sf_dir), PDF_SUFFIX, lang="lang")


def page_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = fill_cores(read(spark, sf_dir, "pages"), "page_id").withColumnRenamed("url", "object_uri")
    return extract_chunks(pages, SCREEN_SUFFIX, text=html_text("html"))


def conversation_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations")
    uri = F.concat(F.lit("conv://"), F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string"))
    return extract_chunks(turns.withColumn("object_uri", uri), IMAGE_SUFFIX)


def page_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page titles stand in for image captions; the order of page ids stands in for their creation time."""
    return read(spark, sf_dir, "pages").select(
        F.sha2("url", 256).alias("image_id"),
        F.col("url").alias("source_uri"),
        html_title("html").alias("caption"),
        F.array().cast("array<string>").alias("dominant_colors"),
        F.lit(None).cast("bigint").alias("width_px"),
        F.lit(None).cast("bigint").alias("height_px"),
        F.timestamp_seconds("page_id").alias("created_ts"),
    )


def document_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = document_chunks(spark, sf_dir).select("chunk_id", "text")
    return hashed_embedding(fill_cores(chunks, "chunk_id"), "chunk_id", "text")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("query_id"), F.col("text").alias("query")
    )


def question_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashed_embedding(questions(spark, sf_dir), "query_id", "query")


def label_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One frequent query per label: the mean vector of all its rows."""
    means = mean_vectors(read(spark, sf_dir, "embeddings"), "label", "embedding")
    return means.select(F.concat(F.lit("label_"), F.col("label").cast("string")).alias("query_id"), "vector")


def label_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("label_"), F.col("label").cast("string")).alias("query_id"), F.col("vec_id").alias("item_id")
    )


# Fixed values (the sentence that each order is written as, and how its parts are found again).
ORDER_ENTITY = "Customer [0-9]+"
ORDER_TOTAL = f"totalling ({NUMBER_PATTERN})"


def order_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as one sentence of text."""
    orders = fill_cores(read(spark, sf_dir, "orders"), "o_orderkey")
    text = F.concat(
        F.lit("Customer "), F.col("o_custkey").cast("string"),
        F.lit(" placed order "), F.col("o_orderkey").cast("string"),
        F.lit(" totalling "), F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
        F.lit(" on "), F.to_date("o_orderdate").cast("string"),
        F.lit(" with status "), F.col("o_orderstatus"), F.lit("."),
    )
    uri = F.concat(F.lit("order://"), F.col("o_orderkey").cast("string"))
    return extract_chunks(orders.select(uri.alias("object_uri"), text.alias("text")), PDF_SUFFIX)


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = rule_facts(entity=ORDER_ENTITY, number=ORDER_TOTAL, number_group=1)
    return extract_facts(order_chunks(spark, sf_dir), model)


def document_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_facts(fill_cores(document_chunks(spark, sf_dir), "chunk_id"))


def last_day(df: DataFrame, ts: str):
    """The newest day of a table as a scalar subquery; a production run passes today instead."""
    return df.agg(F.to_date(F.max(ts)).alias("d")).select("d").scalar()


def kpi_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily orders per priority and daily events per type, whole series."""
    orders, events = read(spark, sf_dir, "orders"), read(spark, sf_dir, "events")
    per_priority = F.concat(F.lit("orders:"), F.col("o_orderpriority"))
    per_type = F.concat(F.lit("events:"), F.col("event_type"))
    return kpi_daily_counts(orders, "o_orderdate", per_priority, days=None).unionByName(
        kpi_daily_counts(events, "ts", per_type, days=None)
    )

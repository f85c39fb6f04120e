"""One registered query per operator: it applies the operator to whole tables and derives the asked columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidex.llm import bpe, centroids, minhash, mixing, negatives, quality, substrings, tokenfile, topk, toxicity, urlfilter, warc, winnowing

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
END_ID = 2

# The rules of the url query, and host labels whose pages stand for a published list of urls.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
LISTED_LABELS = ["adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents, by four-word shingles."""
    return minhash.link(table(spark, sf_dir, "documents"), words=4)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, read back from the archives."""
    records, _, _ = warc.archive(table(spark, sf_dir, "pages"))
    return records.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as token ids in shards, read back from the files."""
    width = 2
    found, _, _ = tokenfile.token_files(table(spark, sf_dir, "documents"), WORD_BPE, END_ID, width)
    return tokenfile.crc_of_ids(found, width)


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows for every vector whose id is divisible by 20."""
    base = table(spark, sf_dir, "embeddings")
    return topk.exact_topk(base, base.filter(F.col("vec_id") % 20 == 0), k=20)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of the voting rules on every document."""
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    ids = bpe.encode(table(spark, sf_dir, "documents"), BYTE_BPE, public_tokenizers.PATTERN)
    both = bpe.decode(ids, BYTE_BPE)
    text = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(text.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url against the rules and the listed urls."""
    pages = table(spark, sf_dir, "pages")
    label = F.regexp_extract(urlfilter.host_of(F.col("url")), r"(?:^|\.)([^.]+)\.[^.]+\.[^.]+$", 1)
    return urlfilter.filter_urls(pages, pages.filter(label.isin(LISTED_LABELS)).select("url"), URL_RULES)


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the target weights of their sources."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("row_id").alias("doc_id"), "size", "source_size", "target", "taken")


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without passages of 35 words that occur anywhere else."""
    cut = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of every document, learnt from the labels that are not held out."""
    scored = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("spans").alias("n_spans"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors in 40 clusters, after five rounds."""
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dim=64)


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vector whose id is divisible by 100, with some labels moved on."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return negatives.mine_negatives(rows, rows.filter(F.col("vec_id") % 100 == 0))


def op13_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its text with the next one's beginning at the end."""
    return winnowing.compare_edits(table(spark, sf_dir, "documents"))


OPERATORS = (
    op1_minhash, op2_warc, op3_tokens, op4_topk, op5_quality, op6_bpe, op7_urls, op8_mix, op9_substrings, op10_toxicity, op11_centroids, op12_negatives, op13_winnowing,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in OPERATORS
}

"""From raw documents to token ids, stage by stage.

Every stage takes the rows that the one before it kept and returns the columns of documents; the last returns token ids.
`run` writes each stage's rows as Parquet to the cluster's shared folder and reads them again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidex.llm import bpe, minhash, mixing, quality, substrings
from evidex.llm.common import numbered_table
from evidex.session import stored

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

# Fixed value: the columns that stages hand on.
DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def _text_key(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the voting rules keep; rows that share an id are judged by their own texts."""
    keyed = docs.select("doc_id", "text", _text_key("text").alias("key"))
    # The verdict is the text's alone, so the key of the text is what the judge gets as id.
    kept = quality.judge(keyed, doc_id="key").filter("kept").select(F.col("doc_id").alias("kept_key")).distinct()
    return docs.join(kept, _text_key("text") == F.col("kept_key"), "left_semi").select(*DOCUMENTS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    Of rows with the same id and text one stays; texts without words and rows without an id are no near-duplicates.
    """
    kept = minhash.link(docs).filter("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    rows = docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi").select(*DOCUMENTS)
    again = docs.filter("doc_id is not null").groupBy("doc_id", _text_key("text").alias("key")).count().filter("count > 1")
    if not again.isEmpty():
        rows = rows.filter("doc_id is null").union(rows.filter("doc_id is not null").dropDuplicates(["doc_id", "text"]))
    return rows


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that occur elsewhere; a document of which no word is left goes."""
    cut = substrings.remove_repeats(docs, keep=("lang", "source")).filter("n_words > n_removed")
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENTS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes its words, to the nearest whole number: none to three times."""
    docs = numbered_table(docs, DOCUMENTS, "mixed")
    mixed = mixing.mix(docs, keep=("text", "lang", "n_chars"), row="row").filter("taken > 0").withColumnRenamed("row_id", "doc_id")
    times = F.round(F.col("taken") / F.col("size")).cast("int")
    return mixed.withColumn("times", times).filter("times > 0").withColumn("pass", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*DOCUMENTS)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens of every text that is left."""
    return bpe.encode(docs, RANKS, public_tokenizers.PATTERN).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("mixing sources", mix_sources),
    ("byte-level BPE", encode_texts),
]

# Voting by expectation-maximisation, the schedule and the merges have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage{n}")
    return docs

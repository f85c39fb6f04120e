"""The registered queries: each runs one operator over whole given tables."""

from __future__ import annotations

import re
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidex.functions.json import json_columns, json_schema
from evidex.functions.scalars import ab_variant, clamp01, first_number, snippet
from evidex.functions.tokens import tokens
from evidex.operators import answers as A
from evidex.operators import bounds as B
from evidex.operators import ivf, kpi, quantiles, seasonal
from evidex.operators import neighbors as N
from evidex.operators import retrieval as R
from evidex.operators import validators as V
from evidex.operators.chunks import chunks_from_captions, pending, prompt_log
from evidex.operators.dictionary import name_match, name_mentions
from evidex.operators.embed import IMAGE_DIM, embed_missing, hashed_embedding
from evidex.operators.generate import generate_bool, generate_double, generate_table
from evidex.operators.model_table import register_model, register_reader
from evidex.operators.sampling import cap_per_key, hash_sample, sample_position
from evidex.operators.vectors import drop_empty_vectors, vector_topk
from evidex.plans import inputs as I
from evidex.plans.evidence import Settings, refresh
from evidex.session import fill_cores, shared_folder, stored
from evidex.sources import days as D
from evidex.sources import writes as S
from evidex.sources.clustered import insert_clustered, write_clustered
from evidex.sources.object_source import folder_chunks, register_objects
from evidex.sources.objects import list_objects, object_catalog
from evidex.streaming.daily import daily_counts, event_days, insert_stream, read_files_as_stream
from evidex.streaming.windows import count_stream, daily_totals

EMBEDDINGS = {"item_id": "vec_id", "vector": "embedding"}
BRAND_WORDS = ("widget", "bolt")
COLOR_STAND_INS = ("the", "der", "la")
IVF_PROBES = 8
MEAN_CELLS = 4096


def _flat_chunks(chunks: DataFrame) -> DataFrame:
    return chunks.select(
        "chunk_id", "source_uri", "text", "lang",
        F.col("span.offset_start").alias("offset_start"), F.col("span.offset_end").alias("offset_end"),
    )


def _flat_facts(facts: DataFrame) -> DataFrame:
    return facts.select(
        "fact_id", "subject", "predicate", "object_value", "object_number", "object_date", "source_uri",
        F.col("source_span.offset_end").alias("offset_end"), "confidence",
    )


# Vectors


def vector_topk_query(spark: SparkSession, sf: str) -> DataFrame:
    return vector_topk(I.read(spark, sf, "embeddings"), I.label_queries(spark, sf), **EMBEDDINGS)


def vector_topk_constrained(spark: SparkSession, sf: str) -> DataFrame:
    return vector_topk(
        I.read(spark, sf, "embeddings"), I.label_queries(spark, sf),
        constraints=[("distance", "<=", 0.9), ("label", "in", (1, 3, 5, 7))], **EMBEDDINGS,
    )


def precomputed_neighbors(spark: SparkSession, sf: str) -> DataFrame:
    found = N.precompute_neighbors(I.read(spark, sf, "embeddings"), I.label_queries(spark, sf), **EMBEDDINGS)
    return found.withColumn("similarity", F.round("similarity", 6))


def _edges(spark: SparkSession, sf: str) -> DataFrame:
    return N.semantic_edges(I.read(spark, sf, "embeddings"), I.label_queries(spark, sf), **EMBEDDINGS)


def semantic_edges(spark: SparkSession, sf: str) -> DataFrame:
    return _edges(spark, sf).withColumn("similarity", F.round("similarity", 6))


def hybrid_top(spark: SparkSession, sf: str) -> DataFrame:
    top = N.hybrid_top(_edges(spark, sf))
    return top.select("left_id", "right_id", F.round("similarity", 6).alias("similarity"), F.round("hybrid_score", 6).alias("hybrid_score"))


def hybrid_preview(spark: SparkSession, sf: str) -> DataFrame:
    top = N.hybrid_preview(_edges(spark, sf))
    return top.select("left_id", "right_id", F.round("hybrid_score", 6).alias("hybrid_score"), "recency_score", "validator_pass_rate")


def _label_metrics(spark: SparkSession, sf: str) -> DataFrame:
    base = I.read(spark, sf, "embeddings")
    return R.retrieval_eval(base, I.label_queries(spark, sf), I.label_truth(spark, sf), **EMBEDDINGS)


def _rounded_metrics(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in ("recall_k", "precision_k", "mrr")})


def retrieval_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_metrics(_label_metrics(spark, sf))


def retrieval_metrics_mean(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_metrics(R.retrieval_metrics_mean(_label_metrics(spark, sf)))


def holdout(spark: SparkSession, sf: str) -> DataFrame:
    queries = R.make_holdout(I.document_chunks(spark, sf), I.document_embeddings(spark, sf))
    return queries.select(
        "query_id", "item_id", F.length("query_text").alias("query_chars"), F.size("vector").alias("vector_dim")
    )


def retrieval_metrics_holdout(spark: SparkSession, sf: str) -> DataFrame:
    embeddings = stored(I.document_embeddings(spark, sf), "text-emb")
    queries = R.make_holdout(I.document_chunks(spark, sf), embeddings)
    return _rounded_metrics(R.retrieval_eval(embeddings, queries, queries, item_id="chunk_id"))


def _context(spark: SparkSession, sf: str, constraints=()) -> DataFrame:
    return R.retrieve_context(
        I.question_vectors(spark, sf), I.document_embeddings(spark, sf), I.document_chunks(spark, sf), constraints=constraints
    )


def context_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _context(spark, sf).withColumn("distance", F.round("distance", 6))


def context_with_fallback(spark: SparkSession, sf: str) -> DataFrame:
    near = _context(spark, sf, [("distance", "<=", 0.4)])
    return R.context_with_fallback(I.questions(spark, sf), near, I.page_captions(spark, sf))


def image_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Search by image: the descriptions nearest to each question, in the space of image vectors."""
    captions = I.page_captions(spark, sf).select("image_id", "caption")
    images = hashed_embedding(captions, "image_id", "caption", IMAGE_DIM)
    questions = hashed_embedding(I.questions(spark, sf), "query_id", "query", IMAGE_DIM)
    return vector_topk(images, questions, R.CONTEXT_K, item_id="image_id").withColumn("distance", F.round("distance", 6))


def neighbors_of_all(spark: SparkSession, sf: str) -> DataFrame:
    """The nearest rows of every row: as many queries as rows, whatever fits into one broadcast."""
    base = I.read(spark, sf, "embeddings")
    return vector_topk(base, base, 5, query_id="vec_id", query_vector="embedding", max_broadcast=100, **EMBEDDINGS)


# Inverted file


def _label_cells(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """Cells around the means of the labels, which SQL can repeat; a production run trains them with k-means."""
    base, queries = I.read(spark, sf, "embeddings"), I.label_queries(spark, sf)
    means = queries.orderBy("query_id").limit(MEAN_CELLS + 1).collect()
    if len(means) > MEAN_CELLS:
        raise ValueError(f"more than {MEAN_CELLS} means of labels as cells")
    centers = np.asarray([r.vector for r in means], dtype=np.float64)
    centers /= np.linalg.norm(centers, axis=1, keepdims=True)
    return ivf.assign_cells(base, centers, "embedding"), queries, centers


def _ivf(spark: SparkSession, sf: str, all_cells: bool) -> tuple[DataFrame, DataFrame]:
    base = I.read(spark, sf, "embeddings")
    cells, queries, centers = _label_cells(spark, sf)
    found = ivf.ivf_topk(cells, queries, centers, nprobe=len(centers) if all_cells else IVF_PROBES, **EMBEDDINGS)
    return found, vector_topk(base, queries, **EMBEDDINGS)


def ivf_full_probe(spark: SparkSession, sf: str) -> DataFrame:
    return _ivf(spark, sf, True)[0]


def ivf_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _ivf(spark, sf, False)[0]


def ivf_recall(spark: SparkSession, sf: str) -> DataFrame:
    return ivf.recall_against(*_ivf(spark, sf, False))


def _stored_cells(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, B.CellBounds]:
    """Stored cells, the queries and the angles between which each cell's rows lie."""
    cells, queries, centers = _label_cells(spark, sf)
    path = shared_folder(spark, "cells")
    ivf.write_cells(cells, path)
    cells = spark.read.parquet(path)
    return cells, queries, B.cell_bounds(B.cell_angles(cells, centers, "embedding"), centers)


def ivf_exact(spark: SparkSession, sf: str) -> DataFrame:
    """The exact nearest rows, from as few cells as their bounds allow."""
    return B.bounded_topk(*_stored_cells(spark, sf), **EMBEDDINGS)[0]


def ivf_cell_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Which cells a query must read: those whose bound is within the distance of its last neighbour."""
    cells, queries, bounds = _stored_cells(spark, sf)
    hits, _ = B.bounded_topk(cells, queries, bounds, **EMBEDDINGS)
    last = hits.groupBy("query_id").agg(F.max("distance").alias("kth"))
    found = B.cells_in_order(queries, bounds).join(last, "query_id")
    return found.select("query_id", "cell", "n_rows", F.round("bound", 6).alias("bound"), (F.col("bound") <= F.col("kth")).alias("may_hold"))


def _index_counts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Present rows of three embedding tables, and the labelled rows as the state of the last build."""
    tables = {
        "text_emb_idx": I.read(spark, sf, "documents"),
        "image_emb_idx": I.read(spark, sf, "pages"),
        "hot_emb_idx": drop_empty_vectors(I.read(spark, sf, "embeddings"), "embedding"),
    }
    counts = S.table_counts(tables).select(F.col("table_name").alias("index_name"), F.col("n").alias("row_count"))
    built = {"text_emb_idx": I.read(spark, sf, "labels"), "image_emb_idx": I.read(spark, sf, "pages")}
    state = S.table_counts(built).select(F.col("table_name").alias("index_name"), F.col("n").alias("last_row_count"))
    return counts, state


def index_decision(spark: SparkSession, sf: str) -> DataFrame:
    made = ivf.index_decision(*_index_counts(spark, sf))
    return made.select("index_name", "row_count", "last_row_count", F.round("growth_pct", 6).alias("growth_pct"), "decision")


def index_state(spark: SparkSession, sf: str) -> DataFrame:
    return ivf.index_state(ivf.index_decision(*_index_counts(spark, sf)))


def index_health(spark: SparkSession, sf: str) -> DataFrame:
    counts, state = _index_counts(spark, sf)
    return ivf.index_health(
        counts.withColumnRenamed("index_name", "table_name"), state.withColumnRenamed("index_name", "table_name")
    )


# Sources and writes


def list_objects_query(spark: SparkSession, sf: str) -> DataFrame:
    """Listed files with what was read from them: chunks and characters of the documents and conversations."""
    listed = list_objects(spark, sf, "*.parquet").select("object_uri").withColumn("key", F.regexp_extract("object_uri", "[^/]+(/[^/]+)?$", 0))
    found = None
    for name in ("documents", "conversations"):
        rows = I.read(spark, sf, name).select(F.col("_metadata.file_path").alias("path"), F.length("text").alias("chars"))
        rows = rows.filter("chars > 0").groupBy("path").agg(F.count("*").alias("n_chunks"), F.sum("chars").alias("n_chars"))
        rows = rows.select(F.lit(name).alias("name"), F.regexp_extract("path", "[^/]+(/[^/]+)?$", 0).alias("key"), "n_chunks", "n_chars")
        found = rows if found is None else found.unionByName(rows)
    return listed.join(found, "key").groupBy("name").agg(F.sum("n_chunks").alias("n_chunks"), F.sum("n_chars").alias("n_chars"))


def object_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Pages written as objects, one folder per language, listed together with some registered ones, and read as chunks."""
    register_objects(spark)
    root = shared_folder(spark, "objects")
    pages = I.read(spark, sf, "pages").select("page_id", F.col("html").cast("binary").alias("content"))
    folder = F.concat(F.lit("p"), (F.col("page_id") % 7).cast("string"), F.lit("/"), F.col("page_id").cast("string"), F.lit(".html"))
    listed = F.col("page_id") % 10 != 0
    pages.filter(listed).select(folder.alias("name"), "content").write.format("objects").mode("append").save(f"{root}/listed")
    pages.filter(~listed).select(folder.alias("name"), "content").write.format("objects").mode("append").save(f"{root}/other")
    # Some URIs are both registered and listed.
    uri = F.concat(F.when(listed, f"{root}/listed/").otherwise(f"{root}/other/"), folder)
    registered = pages.filter(F.col("page_id") % 5 == 0).select(uri.alias("object_uri"), F.lit("text/html").alias("media_type"))
    done = spark.createDataFrame([], "chunk_id string")
    chunks = folder_chunks(spark, f"{root}/listed", registered)(done)
    page = F.regexp_extract("source_uri", r"/([0-9]+)\.html$", 1).cast("bigint")
    return chunks.select(page.alias("page_id"), "text", F.col("span.offset_end").alias("offset_end"))


def object_catalog_query(spark: SparkSession, sf: str) -> DataFrame:
    pages = I.read(spark, sf, "pages").select(F.col("url").alias("object_uri"))
    return object_catalog(pages, I.document_objects(spark, sf), pages)


def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return S.table_counts({name: I.read(spark, sf, name) for name in I.TABLE_NAMES})


def _checked_labels(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    labels = I.read(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("quality"))
    docs = I.read(spark, sf, "documents").select("doc_id", F.lit("unknown").alias("quality"))
    return labels, docs


def pending_documents(spark: SparkSession, sf: str) -> DataFrame:
    labels, docs = _checked_labels(spark, sf)
    return pending(docs, labels, "doc_id").select("doc_id")


def insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    labels, docs = _checked_labels(spark, sf)
    return S.insert_if_absent(labels, docs, ["doc_id"])


def upsert_status(spark: SparkSession, sf: str) -> DataFrame:
    """Newest order status per customer over a table that has every customer as 'none'."""
    customers = I.read(spark, sf, "customer").select("c_custkey", F.lit("none").alias("status"))
    orders = I.read(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("status")
    )
    return S.upsert(customers, orders, ["c_custkey"])


def upsert_edges(spark: SparkSession, sf: str) -> DataFrame:
    base, queries = I.read(spark, sf, "embeddings"), I.label_queries(spark, sf)
    wide = N.semantic_edges(base, queries, 64, **EMBEDDINGS).withColumn("constraints_ok", F.lit(False))
    merged = S.upsert(wide, _edges(spark, sf), N.EDGE_KEYS)
    return merged.select("edge_id", "left_id", "right_id", F.round("similarity", 6).alias("similarity"), "constraints_ok")


def purge_expired(spark: SparkSession, sf: str) -> DataFrame:
    events = I.read(spark, sf, "events")
    now = events.agg(F.max("ts").alias("now")).select("now").scalar()
    return S.purge_expired(events, "ts", now).select("event_id", "event_type", "value")


def purge_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """Events in a folder per day, without those more than ten days old."""
    events = I.read(spark, sf, "events").withColumn("day", F.to_date("ts"))
    now = F.lit(events.agg(F.max("ts")).first()[0])
    path = shared_folder(spark, "events-by-day")
    D.write_days(events, path, "day")
    D.purge_days(spark, path, events.schema, "day", "ts", now, 10 * 24 * 60)
    return D.read_days(spark, path, events.schema, "day").select("event_id", "event_type", "value")


def upsert_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """Daily counts in a folder per day, of which the last ten days become numbers of users."""
    events = I.read(spark, sf, "events").select(F.col("event_type").alias("kpi_id"), "user_id", F.to_date("ts").alias("ts"))
    series = events.groupBy("kpi_id", "ts").agg(F.count("*").alias("value"))
    recent = events.filter(F.col("ts") > F.date_sub(F.lit(I.last_day(events, "ts")), 10))
    path = shared_folder(spark, "counts-by-day")
    D.write_days(series, path, "ts")
    D.upsert_days(spark, path, recent.groupBy("kpi_id", "ts").agg(F.count_distinct("user_id").alias("value")), ["kpi_id", "ts"], "ts")
    return D.read_days(spark, path, series.schema, "ts")


def _clustered(df: DataFrame, key: str) -> tuple[str, str]:
    """Store rows in eight buckets by key: (name, path)."""
    name = f"clustered_{uuid.uuid4().hex}"
    path = shared_folder(df.sparkSession, name)
    write_clustered(df, name, path, [key], 8)
    return name, path


def pending_clustered(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without a label yet, both tables clustered by their id."""
    docs, _ = _clustered(I.read(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    labels, _ = _clustered(I.read(spark, sf, "labels"), "doc_id")
    return pending(spark.table(docs), spark.table(labels), "doc_id")


def insert_clustered_query(spark: SparkSession, sf: str) -> DataFrame:
    """Labels with a row for every document that had none."""
    name, path = _clustered(I.read(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    unknown = I.read(spark, sf, "documents").select("doc_id", F.lit(-1).cast("int").alias("quality"))
    return insert_clustered(unknown, name, path, ["doc_id"], 8)


def drop_empty_vectors_query(spark: SparkSession, sf: str) -> DataFrame:
    """Token lists as the arrays: texts without any token have an empty one."""
    docs = fill_cores(I.read(spark, sf, "documents"), "doc_id")
    words = docs.select("doc_id", tokens("text").alias("vector"))
    return drop_empty_vectors(words).select("doc_id", F.size("vector").alias("n"))


# Sampling and scalars


def hash_sample_query(spark: SparkSession, sf: str) -> DataFrame:
    docs = I.read(spark, sf, "documents")
    return hash_sample(docs, "doc_id", V.SAMPLE_FRAC).select("doc_id", F.round(sample_position("doc_id"), 6).alias("position"))


def cap_per_key_query(spark: SparkSession, sf: str) -> DataFrame:
    events = I.read(spark, sf, "events").select("user_id", "event_id")
    return cap_per_key(events, "user_id", V.MAX_CHECKS_PER_ITEM, ["event_id"])


def ab_variant_query(spark: SparkSession, sf: str) -> DataFrame:
    return I.questions(spark, sf).select("query_id", ab_variant("query").alias("prompt_version"))


def snippets(spark: SparkSession, sf: str) -> DataFrame:
    return I.read(spark, sf, "documents").select(
        "doc_id", snippet("text").alias("snippet"), snippet("text", 96, strip_quotes=True).alias("short_snippet")
    )


def clamp_confidence(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.when(F.col("event_type") != "error", F.col("value") / 10 - 0.5)
    return I.read(spark, sf, "events").select("event_id", F.round(clamp01(raw), 9).alias("confidence"))


# Chunks, embeddings, facts


def chunks_documents(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_chunks(I.document_chunks(spark, sf))


def chunks_pages(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_chunks(I.page_chunks(spark, sf))


def chunks_conversations(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_chunks(I.conversation_chunks(spark, sf))


def chunks_captions(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_chunks(chunks_from_captions(I.page_captions(spark, sf)))


def _long_vectors(df: DataFrame, key: str) -> DataFrame:
    return (
        df.select(key, F.posexplode("vector").alias("bucket", "weight")).filter(F.col("weight") > 0)
        .withColumn("weight", F.round("weight", 6))
    )


def hashed_embedding_query(spark: SparkSession, sf: str) -> DataFrame:
    return _long_vectors(I.document_embeddings(spark, sf), "chunk_id")


def embed_missing_captions(spark: SparkSession, sf: str) -> DataFrame:
    """Captions of the pages; those whose page text also has a chunk of more than 2,000 characters count as done."""
    captions = I.page_captions(spark, sf)
    done = I.page_chunks(spark, sf).filter(F.length("text") > 2000).select(F.sha2("source_uri", 256).alias("image_id"))
    made = embed_missing(captions, done, "image_id", "caption", dim=1024)
    return _long_vectors(made, "image_id")


def facts_documents(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_facts(I.document_facts(spark, sf))


def facts_orders(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_facts(I.order_facts(spark, sf))


def prompt_log_query(spark: SparkSession, sf: str) -> DataFrame:
    work = pending(I.read(spark, sf, "documents"), I.read(spark, sf, "labels"), "doc_id")
    work = work.withColumn("doc", F.col("doc_id").cast("string"))
    return prompt_log(work, "facts_v1", "facts_v1", "rules", "text", "doc")


# Models


class TitleModel:
    """Stand-in for a caption model: the title of a page; it knows nothing of colours and sizes."""

    title = re.compile(r"<title>(.*?)</title>", re.I | re.S)

    def __call__(self, records):
        found = [self.title.search(r["html"] or "") for r in records]
        return [
            {"caption": m.group(1), "dominant_colors": [], "width_px": None, "height_px": None} if m and m.group(1) else None
            for m in found
        ]


class WordModel:
    """Stand-in for an extraction model: number of words and the first one."""

    word = re.compile(r"[^ \t\r\n]+")

    def __call__(self, records):
        found = [self.word.findall(r["text"]) for r in records]
        return [{"n_words": len(w), "first_word": w[0]} if w else None for w in found]


def image_descriptions(spark: SparkSession, sf: str) -> DataFrame:
    schema = "caption string, dominant_colors array<string>, width_px bigint, height_px bigint"
    pages = fill_cores(I.read(spark, sf, "pages").select("url", "html"), "url")
    made = generate_table(pages, TitleModel, ["html"], schema).filter(F.col("out").isNotNull())
    return made.select(
        F.sha2("url", 256).alias("image_id"), F.col("url").alias("source_uri"), "out.caption",
        F.size("out.dominant_colors").alias("n_colors"), "out.width_px", "out.height_px",
    )


def generate_table_query(spark: SparkSession, sf: str) -> DataFrame:
    docs = fill_cores(I.read(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    made = generate_table(docs, WordModel, ["text"], "n_words bigint, first_word string")
    return made.select("doc_id", "out.n_words", "out.first_word")


def generate_table_sql(spark: SparkSession, sf: str) -> DataFrame:
    """The same model as a table function of SQL."""
    register_model(spark, "words_of", WordModel, ["text"], "n_words bigint, first_word string")
    docs = fill_cores(I.read(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    return spark.sql("select doc_id, out.n_words, out.first_word from words_of(table({docs}))", docs=docs)


class TranscriptReader:
    """Reads a conversation turn by turn: how often the speaker changes, and who speaks first and last."""

    def __init__(self):
        self.turns = self.changes = self.chars = 0
        self.conv = self.first = self.last = None

    def read(self, record):
        self.changes += self.turns > 0 and record["role"] != self.last
        self.conv, self.last = record["conv_id"], record["role"]
        self.first = self.last if self.turns == 0 else self.first
        self.turns += 1
        self.chars += len(record["text"] or "")

    def result(self):
        return [{"conv_id": self.conv, "turns": self.turns, "changes": self.changes, "chars": self.chars, "first_role": self.first, "last_role": self.last}]


def transcripts_sql(spark: SparkSession, sf: str) -> DataFrame:
    """Each conversation in the order of its turns, by a table function that reads one group after another."""
    schema = "conv_id bigint, turns bigint, changes bigint, chars bigint, first_role string, last_role string"
    register_reader(spark, "transcript", TranscriptReader, ["conv_id", "role", "text"], schema)
    return spark.sql("select * from transcript(table({turns}) partition by conv_id order by turn)", turns=I.read(spark, sf, "conversations"))


class LengthModel:
    """Stand-in for a yes/no model: is the text longer than a thousand characters?"""

    def __call__(self, records):
        return [{"result": len(r["text"]) > 1000} for r in records]


class ShareModel:
    """Stand-in for a scoring model: an eighth of the number of pieces between blanks; none for an empty text."""

    def __call__(self, records):
        return [{"result": len(r["text"].split(" ")) / 8} if r["text"] else None for r in records]


def generate_bool_query(spark: SparkSession, sf: str) -> DataFrame:
    docs = I.read(spark, sf, "documents").select("doc_id", "text").filter("text is not null")
    return generate_bool(docs, LengthModel, ["text"]).select("doc_id", "result")


def generate_double_query(spark: SparkSession, sf: str) -> DataFrame:
    docs = I.read(spark, sf, "documents").select("doc_id", "text").filter("text is not null")
    return generate_double(docs, ShareModel, ["text"]).select("doc_id", "result")


# Validators


def validator_quality_results(spark: SparkSession, sf: str) -> DataFrame:
    labels = I.read(spark, sf, "labels")
    done = labels.filter("toxic = 1").select(F.col("doc_id").cast("string").alias("item_id"), F.lit("rule_quality").alias("rule_id"))
    return V.run_bool_validator(labels, "rule_quality", "doc_id", F.col("quality") == 1, done=done, sample_frac=V.SAMPLE_FRAC, cap=None)


def validator_bool_results(spark: SparkSession, sf: str) -> DataFrame:
    events = I.read(spark, sf, "events")
    return V.run_bool_validator(events, "rule_value", "user_id", F.col("value") > 10, tiebreak=["event_id"])


def validator_tolerance_results(spark: SparkSession, sf: str) -> DataFrame:
    """Total written in the text of an order against the sum of its lines."""
    lines = I.read(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("line_total")
    )
    orders = I.read(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("total: "), F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("text")
    )
    rows = orders.join(lines, orders.o_orderkey == lines.l_orderkey)
    return V.run_tolerance_validator(
        rows, "rule_total", "o_orderkey", first_number("text"), "line_total", 0.5, sample_frac=V.SAMPLE_FRAC, cap=None
    )


def validator_brand_results(spark: SparkSession, sf: str) -> DataFrame:
    parts = I.read(spark, sf, "part").select(F.col("p_partkey").alias("image_id"), F.col("p_name").alias("caption"))
    return V.brand_model_match(parts, BRAND_WORDS, cap=None)


def validator_color_results(spark: SparkSession, sf: str) -> DataFrame:
    """Page titles as captions, with words of the test tables' language as colours."""
    captions = I.page_captions(spark, sf).filter("caption is not null")
    return V.run_bool_validator(captions, "rule_color_match", "image_id", V.mentions_any("caption", COLOR_STAND_INS), cap=None)


def _dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """Names to look for: of all parts, and the first two words of all documents."""
    opening = F.regexp_extract(F.lower("text"), "^[a-z0-9]+ [a-z0-9]+", 0)
    openings = I.read(spark, sf, "documents").select(opening.alias("name"))
    return I.read(spark, sf, "part").select(F.col("p_name").alias("name")).union(openings)


def name_mentions_query(spark: SparkSession, sf: str) -> DataFrame:
    return name_mentions(I.read(spark, sf, "documents"), _dictionary(spark, sf), "doc_id", "text")


def validator_names_results(spark: SparkSession, sf: str) -> DataFrame:
    turns = I.read(spark, sf, "conversations").withColumn("turn_id", F.concat_ws("/", "conv_id", "turn"))
    return name_match(turns, _dictionary(spark, sf), "text", "rule_names", "turn_id", cap=None)


def validator_table_text_results(spark: SparkSession, sf: str) -> DataFrame:
    return V.table_vs_text_total(I.order_facts(spark, sf).unionByName(I.document_facts(spark, sf)), cap=None)


def _all_results(spark: SparkSession, sf: str) -> DataFrame:
    out = validator_quality_results(spark, sf)
    for more in (validator_bool_results, validator_tolerance_results, validator_brand_results, validator_table_text_results):
        out = out.unionByName(more(spark, sf))
    return out


def validator_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return V.validator_coverage(_all_results(spark, sf)).withColumn("pass_rate", F.round("pass_rate", 9))


def validator_rollup(spark: SparkSession, sf: str) -> DataFrame:
    rules = V.validator_rollup(_all_results(spark, sf)).select(F.explode("validators").alias("v"))
    return rules.select("v.name", "v.result", "v.note")


# Answers


def _answers(spark: SparkSession, sf: str, with_rules: bool = False) -> DataFrame:
    rollup = V.validator_rollup(_small_results(spark, sf)) if with_rules else None
    return A.synthesize_answers(I.questions(spark, sf), _context(spark, sf), rollup=rollup)


def _small_results(spark: SparkSession, sf: str) -> DataFrame:
    return validator_quality_results(spark, sf).unionByName(validator_brand_results(spark, sf))


def answers_extractive(spark: SparkSession, sf: str) -> DataFrame:
    rules = F.array_join(
        F.transform("validators", lambda v: F.concat(v["name"], F.lit("="), v["result"].cast("string"))), ", "
    )
    return _answers(spark, sf, True).select(
        "answer_id", "query_id", "prompt_version", "summary", F.array_join("citations", ", ").alias("cites"),
        rules.alias("rules"), F.round("confidence", 9).alias("confidence"),
    )


def context_texts(spark: SparkSession, sf: str) -> DataFrame:
    """What a plugged-in model gets to read for each question."""
    inputs = A.answer_inputs(I.questions(spark, sf), _context(spark, sf))
    return inputs.select("query_id", "context_text", "allowed_sources")


def answer_cards(spark: SparkSession, sf: str) -> DataFrame:
    cards = A.answer_cards(_answers(spark, sf))
    return cards.withColumn("confidence", F.round("confidence", 9))


def answer_rules(spark: SparkSession, sf: str) -> DataFrame:
    return A.answer_rules(_answers(spark, sf, True))


def event_props(spark: SparkSession, sf: str) -> DataFrame:
    """Values out of the JSON of each event."""
    events = I.read(spark, sf, "events").select("event_id", "props")
    made = json_columns(events, "props", {"k": ("$.k", "bigint"), "text": ("$.k", "string"), "missing": ("$.none[0]", "double")}, "is_json")
    return made.drop("props")


def event_props_schema(spark: SparkSession, sf: str) -> DataFrame:
    return json_schema(I.read(spark, sf, "events"), "props", "event_type")


def latest_answer(spark: SparkSession, sf: str) -> DataFrame:
    """The number of a question stands in for the time of its answer."""
    asked = F.timestamp_seconds(F.substring("query_id", 2, 20).cast("bigint"))
    latest = A.latest_answer(_answers(spark, sf).withColumn("created_ts", asked))
    return latest.select("query", "summary", "cites", "n_citations", "confidence")


# KPIs


def kpi_daily_counts(spark: SparkSession, sf: str) -> DataFrame:
    orders = I.read(spark, sf, "orders")
    series = kpi.kpi_daily_counts(orders, "o_orderdate", "orders", I.last_day(orders, "o_orderdate"))
    return series.select("kpi_id", "ts", "value")


def kpi_from_facts(spark: SparkSession, sf: str) -> DataFrame:
    orders = I.read(spark, sf, "orders")
    facts = I.order_facts(spark, sf).unionByName(I.document_facts(spark, sf))
    series = kpi.kpi_from_facts(facts, I.last_day(orders, "o_orderdate"))
    return series.select("kpi_id", "ts", "value")


def _rounded_forecast(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("predicted", "lower", "upper")})


def forecast(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_forecast(kpi.forecast(I.kpi_series(spark, sf)))


def forecast_backtest(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_forecast(kpi.forecast_backtest(I.kpi_series(spark, sf)))


def forecast_seasonal(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_forecast(seasonal.seasonal_forecast(I.kpi_series(spark, sf)))


def forecast_seasonal_backtest(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_forecast(seasonal.seasonal_backtest(I.kpi_series(spark, sf)))


def forecast_errors(spark: SparkSession, sf: str) -> DataFrame:
    """The line and the seasonal forecast of each KPI against its last two weeks."""
    series = I.kpi_series(spark, sf)
    line = kpi.forecast_backtest(series, 14).withColumn("method", F.lit("line"))
    both = line.unionByName(seasonal.seasonal_backtest(series, 14).withColumn("method", F.lit("seasonal")))
    return seasonal.backtest_errors(both, "method").withColumns({c: F.round(c, 6) for c in ("mae", "coverage")})


def kpi_cards(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_forecast(kpi.kpi_cards(kpi.forecast(I.kpi_series(spark, sf))))


def forecast_summary(spark: SparkSession, sf: str) -> DataFrame:
    made = kpi.forecast_summary(kpi.forecast(I.kpi_series(spark, sf)))
    return made.withColumns({c: F.round(c, 6) for c in ("p25", "p50", "p75")})


def forecast_summary_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """The summary from the sketches of two methods' runs, stored one after the other."""
    series = I.kpi_series(spark, sf)
    line, weekly = kpi.forecast(series), seasonal.seasonal_forecast(series)
    kept = stored(quantiles.forecast_sketches(line), "sketch").unionByName(stored(quantiles.forecast_sketches(weekly), "sketch"))
    made = quantiles.forecast_summary(kept)
    return made.withColumns({c: F.round(c, 6) for c in ("p25", "p50", "p75")})


def order_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Prices per order priority from sketches per day, and whether their true ranks are within the error."""
    orders = I.read(spark, sf, "orders").select(F.col("o_orderpriority").alias("kpi_id"), F.to_date("o_orderdate").alias("run_id"), F.col("o_totalprice").alias("value"))
    days = stored(quantiles.value_sketches(orders, ["kpi_id", "run_id"]), "sketch")
    merged = stored(quantiles.merge_sketches(days, ["kpi_id"]), "merged")
    within = quantiles.rank_errors(orders, merged, ["kpi_id"], (0.05, 0.25, 0.5, 0.75, 0.95))
    right = within.groupBy("kpi_id").agg(F.bool_and(F.col("rank_error") <= quantiles.RANK_ERROR).alias("within_error"))
    return quantiles.quantiles(merged, (0.0, 1.0), ("lowest", "highest")).join(right, "kpi_id")


def forecast_preview(spark: SparkSession, sf: str) -> DataFrame:
    made = kpi.forecast_preview(kpi.forecast(I.kpi_series(spark, sf)), "events:click")
    return made.withColumn("predicted", F.round("predicted", 6))


# Streams


def stream_daily_counts(spark: SparkSession, sf: str) -> DataFrame:
    I.use_utc(spark)
    out = shared_folder(spark, "daily-counts")
    tables = S.TableFolder(spark, f"{out}/tables")
    events = read_files_as_stream(spark, sf, "events.parquet")
    insert_stream(events, tables, "event_days", f"{out}/state", lambda batch: event_days(batch, "ts", "event_type", "event_id"))
    return daily_counts(tables.read("event_days"))


def stream_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Events per type and day through the state store."""
    I.use_utc(spark)
    out = shared_folder(spark, "windows")
    count_stream(read_files_as_stream(spark, sf, "events.parquet"), out, "ts", "event_type", "event_id")
    return daily_totals(spark, out)


def stream_chunks(spark: SparkSession, sf: str) -> DataFrame:
    I.use_utc(spark)
    out = shared_folder(spark, "stream-chunks")
    tables = S.TableFolder(spark, f"{out}/tables")
    turns = read_files_as_stream(spark, sf, "conversations.parquet")
    uri = F.concat(F.lit("conv://"), F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string"))
    insert_stream(
        turns.withColumn("object_uri", uri), tables, "text_chunks", f"{out}/state",
        lambda batch: I.extract_chunks(batch, I.IMAGE_SUFFIX),
    )
    return _flat_chunks(tables.read("text_chunks"))


# The whole refresh


def stored_run_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Row counts of all stored tables after one refresh over documents, pages, conversations and orders."""
    tables = S.TableFolder(spark, shared_folder(spark, "evidence"))
    orders = I.read(spark, sf, "orders")
    today = I.last_day(orders, "o_orderdate")
    refresh(
        tables,
        [I.document_chunks(spark, sf), I.page_chunks(spark, sf), I.conversation_chunks(spark, sf)],
        I.questions(spark, sf),
        [kpi.kpi_daily_counts(orders, "o_orderdate", "orders", today)],
        today,
        I.page_captions(spark, sf),
        Settings(brand_words=("the", "der", "la")),
    )
    return tables.counts()


QUERIES = {
    "vector_topk": vector_topk_query,
    "vector_topk_constrained": vector_topk_constrained,
    "precomputed_neighbors": precomputed_neighbors,
    "semantic_edges": semantic_edges,
    "hybrid_top": hybrid_top,
    "hybrid_preview": hybrid_preview,
    "retrieval_metrics": retrieval_metrics,
    "retrieval_metrics_mean": retrieval_metrics_mean,
    "holdout": holdout,
    "retrieval_metrics_holdout": retrieval_metrics_holdout,
    "context_topk": context_topk,
    "context_with_fallback": context_with_fallback,
    "image_topk": image_topk,
    "neighbors_of_all": neighbors_of_all,
    "ivf_full_probe": ivf_full_probe,
    "ivf_topk": ivf_topk,
    "ivf_recall": ivf_recall,
    "ivf_exact": ivf_exact,
    "ivf_cell_bounds": ivf_cell_bounds,
    "index_decision": index_decision,
    "index_state": index_state,
    "index_health": index_health,
    "list_objects": list_objects_query,
    "object_chunks": object_chunks,
    "object_catalog": object_catalog_query,
    "table_counts": table_counts,
    "pending_documents": pending_documents,
    "insert_if_absent": insert_if_absent,
    "upsert_status": upsert_status,
    "upsert_edges": upsert_edges,
    "purge_expired": purge_expired,
    "drop_empty_vectors": drop_empty_vectors_query,
    "hash_sample": hash_sample_query,
    "cap_per_key": cap_per_key_query,
    "ab_variant": ab_variant_query,
    "snippets": snippets,
    "clamp_confidence": clamp_confidence,
    "chunks_documents": chunks_documents,
    "chunks_pages": chunks_pages,
    "chunks_conversations": chunks_conversations,
    "chunks_captions": chunks_captions,
    "hashed_embedding": hashed_embedding_query,
    "embed_missing_captions": embed_missing_captions,
    "facts_documents": facts_documents,
    "facts_orders": facts_orders,
    "prompt_log": prompt_log_query,
    "image_descriptions": image_descriptions,
    "generate_table": generate_table_query,
    "generate_table_sql": generate_table_sql,
    "transcripts_sql": transcripts_sql,
    "generate_bool": generate_bool_query,
    "generate_double": generate_double_query,
    "validator_color": validator_color_results,
    "context_texts": context_texts,
    "validator_quality": validator_quality_results,
    "validator_bool": validator_bool_results,
    "validator_tolerance": validator_tolerance_results,
    "validator_brand": validator_brand_results,
    "name_mentions": name_mentions_query,
    "validator_names": validator_names_results,
    "purge_by_day": purge_by_day,
    "pending_clustered": pending_clustered,
    "insert_clustered": insert_clustered_query,
    "upsert_by_day": upsert_by_day,
    "validator_table_text": validator_table_text_results,
    "validator_coverage": validator_coverage,
    "validator_rollup": validator_rollup,
    "answers_extractive": answers_extractive,
    "answer_cards": answer_cards,
    "answer_rules": answer_rules,
    "latest_answer": latest_answer,
    "event_props": event_props,
    "event_props_schema": event_props_schema,
    "kpi_daily_counts": kpi_daily_counts,
    "kpi_from_facts": kpi_from_facts,
    "forecast": forecast,
    "forecast_backtest": forecast_backtest,
    "forecast_seasonal": forecast_seasonal,
    "forecast_seasonal_backtest": forecast_seasonal_backtest,
    "forecast_errors": forecast_errors,
    "kpi_cards": kpi_cards,
    "forecast_summary": forecast_summary,
    "forecast_summary_sketch": forecast_summary_sketch,
    "order_quantiles": order_quantiles,
    "forecast_preview": forecast_preview,
    "stream_daily_counts": stream_daily_counts,
    "stream_windows": stream_windows,
    "stream_chunks": stream_chunks,
    "stored_run_counts": stored_run_counts,
}

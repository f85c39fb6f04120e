"""One refresh of all evidence tables, in their order of dependence. A second run only does what is new."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidex.functions.scalars import SEED, first_number, stable_id
from evidex.operators import answers as A
from evidex.operators import ivf, kpi, quantiles, seasonal
from evidex.operators import neighbors as N
from evidex.operators import retrieval as R
from evidex.operators import validators as V
from evidex.operators.chunks import call_id, chunks_from_captions, pending, prompt_log
from evidex.operators.embed import HASHED_MODEL, IMAGE_DIM, TEXT_DIM, embed_missing, hashed_embedding
from evidex.operators.facts import answered, ask_facts, fact_id, usable_facts
from evidex.operators.vectors import vector_topk
from evidex.session import Intermediate, stored
from evidex.sources.writes import CACHE_TTL_MIN, TableFolder, table_counts

COLOR_WORDS = (
    "red", "orange", "yellow", "green", "blue", "purple", "pink", "brown", "black", "white", "grey",
)
Embedder = Callable[[DataFrame, str, str, int], DataFrame]
Model = Column | Callable[[DataFrame], DataFrame] | None
Chunks = DataFrame | Callable[[DataFrame], DataFrame]


@dataclass
class Settings:
    """What a run may vary; the defaults are those of the operators."""

    text_dim: int = TEXT_DIM
    image_dim: int = IMAGE_DIM
    search_k: int = R.SEARCH_K
    neighbor_k: int = N.NEIGHBOR_K
    context_k: int = R.CONTEXT_K
    holdout: int = R.HOLDOUT_SIZE
    sample_frac: float = V.SAMPLE_FRAC
    seed: int = SEED
    ttl_min: int = CACHE_TTL_MIN
    horizon: int = kpi.HORIZON_DAYS
    # Forecasts by weekday where a KPI has two weeks of values, and by the straight line elsewhere.
    seasonal: bool = False
    split_frac: float = 0.5
    brand_words: Sequence[str] = ("brand",)
    color_words: Sequence[str] = COLOR_WORDS
    embedder: Embedder = hashed_embedding
    embed_model_id: str = HASHED_MODEL
    # Adds `out` with (caption, dominant_colors, width_px, height_px) to images, see `generate_table`.
    caption_model: Callable[[DataFrame], DataFrame] | None = None
    fact_model: Model = None
    answer_model: Model = None
    # Cells of an index (the root of its rows by default), the share of rows it is trained on, and how many cells a
    # question reads; without the last, search is exact over all rows.
    index_cells: int | None = None
    training_share: float = 1.0
    probes: int | None = None


def refresh_captions(t: TableFolder, s: Settings, images: DataFrame) -> None:
    """Describe the images (object_uri, ...) that have no description yet, and log what was asked."""
    todo = pending(images.withColumn("image_id", F.sha2("object_uri", 256)), t.read("image_desc"), "image_id")
    made = answered(stored(s.caption_model(todo), "captions"))
    described = made.filter("out.caption is not null").select("image_id", F.col("object_uri").alias("source_uri"), "out.*")
    t.insert("image_desc", described)
    t.insert("prompt_log", prompt_log(made, "captions_v1", "captions_v1", "captions", "object_uri", "image_id"))


def refresh_chunks(t: TableFolder, chunks: Sequence[Chunks], image_desc: DataFrame | None) -> None:
    """Store new chunks. A function among them gets the stored chunks and leaves out what is there before it extracts."""
    found = [c(t.read("text_chunks")) if callable(c) else c for c in chunks]
    if image_desc is not None:
        t.insert("image_desc", image_desc)
    if not t.read("image_desc").isEmpty():
        found.append(chunks_from_captions(t.read("image_desc")))
    t.insert("text_chunks", reduce(DataFrame.unionByName, found))


def refresh_embeddings(t: TableFolder, s: Settings) -> None:
    for rows, out, key, text, dim in (
        ("text_chunks", "text_emb", "chunk_id", "text", s.text_dim),
        ("image_desc", "image_emb", "image_id", "caption", s.image_dim),
    ):
        made = embed_missing(t.read(rows), t.read(out), key, text, dim, s.embed_model_id, s.embedder)
        t.insert(out, made)


INDEXES = {"text_emb_idx": ("text_emb", "chunk_id"), "image_emb_idx": ("image_emb", "image_id")}


def refresh_index(t: TableFolder, s: Settings) -> None:
    """Build what is due, put new rows into the cells of what stays, and record only what was built."""
    counts = table_counts({index_name: t.read(table) for index_name, (table, _) in INDEXES.items()})
    counts = counts.select(F.col("table_name").alias("index_name"), F.col("n").alias("row_count"))
    decisions = stored(ivf.index_decision(counts, t.read("metrics_index_state")), "decisions")
    # One row per index.
    for row in decisions.collect():
        name, (table, key) = row.index_name, INDEXES[row.index_name]
        rows, index = t.read(table).select(key, "vector"), t.read_index(name)
        if row.decision in ("CREATE", "REBUILD") or (row.decision == "KEEP" and index is None):
            centers = ivf.train_cells(rows, s.index_cells, seed=s.seed, training_share=s.training_share)
            t.write_index(name, ivf.assign_cells(rows, centers), centers)
        elif index is not None:
            cells, centers = index
            t.add_to_index(name, ivf.assign_cells(pending(rows, cells, key), np.asarray(centers)))
    t.upsert("metrics_index_state", ivf.index_state(decisions))


def refresh_facts(t: TableFolder, s: Settings) -> None:
    """Ask for facts of the chunks that no logged call covers, also not one without a usable fact.

    The answers are stored before they are used, so a model is asked once per chunk. Rows it failed on are not logged
    and stay pending.
    """
    version = F.lit("facts_v1")
    chunks = t.read("text_chunks").withColumn("call_id", call_id("facts_v1", version, "chunk_id"))
    todo = pending(chunks, t.read("prompt_log"), "call_id")
    with Intermediate(t.spark) as steps:
        made = answered(steps.stored(ask_facts(todo.withColumn("fact_id", fact_id()), s.fact_model), "facts"))
        t.insert("facts_generic", usable_facts(made))
        t.insert("prompt_log", prompt_log(made, "facts_v1", version, "facts", "text", "chunk_id"))


def refresh_holdout(t: TableFolder, s: Settings) -> None:
    """Seed queries and truth once, from the same rows."""
    if not (t.read("hot_queries").isEmpty() and t.read("retrieval_gt").isEmpty()):
        return
    rows = R.make_holdout(
        t.read("text_chunks"), t.read("text_emb"), s.holdout, lambda df, key, text: s.embedder(df, key, text, s.text_dim)
    )
    t.insert("hot_queries", rows.select("query_id", "query_text", F.col("vector").alias("embedding")))
    t.insert("retrieval_gt", rows.select("query_id", "item_id"))


def refresh_validators(t: TableFolder, s: Settings) -> None:
    done = t.read("metrics_validators")
    images, facts = t.read("image_desc"), t.read("facts_generic")
    # Both tables have unique ids, so that there is nothing to cap.
    every = {"done": done, "seed": s.seed, "cap": None}
    sampled = {**every, "sample_frac": s.sample_frac}
    asked = [
        (V.checks_due(images, "rule_color_match", "image_id", **sampled), "color", "caption"),
        (V.checks_due(facts, "rule_total", "fact_id", **sampled), "total", "object_value"),
    ]
    logs = [
        prompt_log(due, f"validator_v1:{name}", "validator_v1", "validator", F.coalesce(text, F.lit("")), "item_id")
        for due, name, text in asked
    ]
    results = [
        V.run_bool_validator(images, "rule_color_match", "image_id", V.mentions_any("caption", s.color_words), **sampled),
        V.run_tolerance_validator(facts, "rule_total", "fact_id", first_number("object_value"), "object_number", **sampled),
        V.brand_model_match(images, s.brand_words, **every),
        V.table_vs_text_total(facts, **every),
    ]
    t.insert("prompt_log", reduce(DataFrame.unionByName, logs))
    t.insert("metrics_validators", reduce(DataFrame.unionByName, results))


def refresh_neighbors(t: TableFolder, s: Settings) -> None:
    """Neighbours, edges and retrieval quality of the hot queries, from one search over the base."""
    for name in ("edges_semantic", "precomputed_neighbors"):
        t.purge(name, s.ttl_min)
    k = max(s.neighbor_k, s.search_k)
    found = vector_topk(t.read("text_emb"), t.read("hot_queries"), k, item_id="chunk_id", query_vector="embedding")
    hits = stored(found, "hits")
    # A query's list is replaced as a whole, so that nothing stays that fell out of it.
    t.replace("precomputed_neighbors", N.neighbors_of(hits, s.neighbor_k), ["query_id"])
    t.replace("edges_semantic", N.edges_of(hits, s.search_k), ["left_id", "left_type"])
    t.upsert("metrics_retrieval", R.retrieval_metrics(hits, t.read("retrieval_gt"), s.search_k))


def context_for(t: TableFolder, s: Settings, questions: DataFrame, constraints=()) -> DataFrame:
    """Context per question from the stored tables: nearest chunks, then recent captions."""
    vectors = s.embedder(questions, "query_id", "query", s.text_dim)
    index = t.read_index("text_emb_idx") if s.probes else None
    if index is None:
        near = R.retrieve_context(vectors, t.read("text_emb"), t.read("text_chunks"), s.context_k, constraints)
    else:
        cells, centers = index
        probes = ivf.nearest_cells(vectors, np.asarray(centers), s.probes, "query_id")
        near = R.retrieve_context(vectors, cells, t.read("text_chunks"), s.context_k, constraints, probes=probes)
    return R.context_with_fallback(questions, near, t.read("image_desc"), s.context_k)


def refresh_answers(t: TableFolder, s: Settings, questions: DataFrame) -> None:
    """Answer the questions (query_id, query) that have no answer from this context yet, and log the variant each used.

    An answer is keyed by its question and context, so new evidence gives a new one and the same asks no model.
    """
    context = stored(context_for(t, s, questions), "context")
    # At most context_k rows per question.
    item = F.struct("rank", "source_uri", F.sha2("text", 256).alias("text"))
    seen = context.groupBy("query_id").agg(F.sha2(F.to_json(F.array_sort(F.collect_list(item))), 256).alias("context_key"))
    bar = F.lit("|")
    asked = questions.join(seen, "query_id", "left").withColumn("version", A.ab_variant("query", s.split_frac))
    key = stable_id("query_id", bar, "version", bar, "query", bar, F.coalesce("context_key", F.lit("")))
    todo = stored(pending(asked.withColumn("answer_id", key), t.read("answers"), "answer_id"), "questions")
    rollup = V.validator_rollup(t.read("metrics_validators"))
    made = A.synthesize_answers(todo.select("query_id", "query"), context, s.answer_model, rollup, s.context_k, s.split_frac)
    t.insert("answers", made.drop("answer_id").join(todo.select("query_id", "answer_id"), "query_id"))
    t.insert("prompt_log", prompt_log(todo, "answer_v1", F.col("version"), "answer", "query", "answer_id"))


def refresh_kpis(t: TableFolder, s: Settings, daily: Sequence[DataFrame], as_of: Column | date) -> None:
    """Series from facts and from daily counts, then forecasts and backtests of all KPIs."""
    found = [kpi.kpi_from_facts(t.read("facts_generic"), as_of), *daily]
    t.upsert("kpi_series", reduce(DataFrame.unionByName, found))
    series = t.read("kpi_series")
    made = kpi.forecast(series, s.horizon)
    made = made.unionByName(kpi.forecast_backtest(series, horizon=s.horizon).select(made.columns))
    if s.seasonal:
        weekly = seasonal.seasonal_forecast(series, s.horizon)
        weekly = stored(weekly.unionByName(seasonal.seasonal_backtest(series, horizon=s.horizon).select(weekly.columns)), "seasonal")
        made = weekly.unionByName(made.join(weekly.select("kpi_id", "backtest").distinct(), ["kpi_id", "backtest"], "left_anti").select(weekly.columns))
    made = stored(made, "forecasts")
    t.upsert("kpi_forecast", made)
    # A run's quartiles are kept with it, so that a summary does not read the rows of all runs.
    t.insert("kpi_sketch", quantiles.forecast_sketches(made))


def refresh(
    t: TableFolder,
    chunks: Sequence[Chunks],
    questions: DataFrame,
    daily: Sequence[DataFrame],
    as_of: Column | date,
    image_desc: DataFrame | None = None,
    settings: Settings | None = None,
    images: DataFrame | None = None,
) -> None:
    """All steps. Every step reads what the ones before have stored.

    `image_desc` are descriptions that exist; `images` are described here by `caption_model`, those that are new.
    """
    s = settings or Settings()
    if images is not None:
        refresh_captions(t, s, images)
    refresh_chunks(t, chunks, image_desc)
    refresh_embeddings(t, s)
    refresh_index(t, s)
    refresh_facts(t, s)
    refresh_holdout(t, s)
    refresh_validators(t, s)
    refresh_neighbors(t, s)
    refresh_answers(t, s, questions)
    refresh_kpis(t, s, daily, as_of)

"""Schemas and keys of the stored tables."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values (columns and keys of the evidence tables, created_ts is added when rows are written).
SPAN = "struct<offset_start: bigint, offset_end: bigint>"
CHECK = "struct<name: string, result: boolean, note: string>"


@dataclass(frozen=True)
class TableSpec:
    columns: str
    keys: tuple[str, ...]
    by_day: bool = False


TABLES: dict[str, TableSpec] = {
    "objects_images": TableSpec("object_uri string, media_type string", ("object_uri",)),
    "objects_pdfs": TableSpec("object_uri string, media_type string", ("object_uri",)),
    "objects_screens": TableSpec("object_uri string, media_type string", ("object_uri",)),
    "text_chunks": TableSpec(f"chunk_id string, source_uri string, text string, lang string, span {SPAN}", ("chunk_id",)),
    "image_desc": TableSpec(
        "image_id string, source_uri string, caption string, dominant_colors array<string>, width_px bigint, height_px bigint",
        ("image_id",),
    ),
    "text_emb": TableSpec("chunk_id string, model_id string, vector array<double>, vector_dim bigint", ("chunk_id",), True),
    "image_emb": TableSpec("image_id string, model_id string, vector array<double>, vector_dim bigint", ("image_id",), True),
    "facts_generic": TableSpec(
        "fact_id string, subject string, predicate string, object_value string, object_number double, object_date date, "
        f"source_uri string, source_span {SPAN}, confidence double",
        ("fact_id",),
    ),
    "edges_semantic": TableSpec(
        "edge_id string, left_id string, right_id string, left_type string, right_type string, similarity double, "
        "constraints_ok boolean, constraint_notes string",
        ("left_id", "right_id", "left_type", "right_type"),
    ),
    "answers": TableSpec(
        f"answer_id string, query string, summary string, citations array<string>, validators array<{CHECK}>, confidence double",
        ("answer_id",),
    ),
    "event_days": TableSpec("event_key string, kpi_id string, day date", ("event_key",)),
    "kpi_series": TableSpec("kpi_id string, ts date, value double, tags array<string>", ("kpi_id", "ts")),
    "kpi_forecast": TableSpec(
        "run_id string, kpi_id string, ts date, predicted double, lower double, upper double, backtest boolean",
        ("run_id", "kpi_id", "ts"),
    ),
    "kpi_sketch": TableSpec("kpi_id string, run_id string, n bigint, first_ts date, last_ts date, sketch binary", ("kpi_id", "run_id")),
    "metrics_validators": TableSpec(
        "item_id string, rule_id string, result_bool boolean, score double, note string", ("item_id", "rule_id"), True
    ),
    "metrics_retrieval": TableSpec(
        "query_id string, k bigint, recall_k double, precision_k double, mrr double", ("query_id", "k")
    ),
    "prompt_log": TableSpec(
        "call_id string, prompt_id string, prompt_version string, model_id string, input_hash string", ("call_id",)
    ),
    "metrics_index_state": TableSpec("index_name string, last_row_count bigint", ("index_name",)),
    "hot_queries": TableSpec("query_id string, query_text string, embedding array<double>", ("query_id",)),
    "precomputed_neighbors": TableSpec(
        "query_id string, neighbor_id string, neighbor_type string, similarity double",
        ("query_id", "neighbor_id", "neighbor_type"),
    ),
    "retrieval_gt": TableSpec("query_id string, item_id string", ("query_id", "item_id")),
}

# Tables that are updated or purged. They only hold rows per frequent query, per KPI day or per index, so a
# rewrite is small; every other table is append-only.
REWRITTEN = frozenset(
    {"edges_semantic", "precomputed_neighbors", "kpi_series", "kpi_forecast", "metrics_retrieval", "metrics_index_state"}
)

"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_QUERIES comma-separated names, or "all", instead of the headline list
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from evidex.operators import kpi  # noqa: E402
from evidex.operators import neighbors as N  # noqa: E402
from evidex.operators.answers import synthesize_answers  # noqa: E402
from evidex.plans import inputs as I  # noqa: E402
from evidex.plans.evidence import Settings, context_for, refresh_index  # noqa: E402
from evidex.plans.registered import QUERIES  # noqa: E402
from evidex.session import local_session, shared_folder  # noqa: E402
from evidex.sources.writes import TableFolder  # noqa: E402

HEADLINE = [
    "vector_topk", "precomputed_neighbors", "semantic_edges", "hybrid_top", "retrieval_metrics",
    "retrieval_metrics_holdout", "context_topk", "context_with_fallback", "answers_extractive",
    "image_topk", "neighbors_of_all", "ivf_topk", "hashed_embedding", "chunks_pages", "facts_documents", "facts_orders",
    "validator_coverage", "insert_if_absent", "kpi_daily_counts", "kpi_from_facts", "forecast",
    "forecast_backtest", "ivf_exact", "forecast_seasonal", "order_quantiles", "event_props", "generate_table_sql", "stream_windows",
]


def timed(make) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def run(spark, name: str, sf_dir: str) -> float:
    return timed(lambda: QUERIES[name](spark, sf_dir))


def stored_paths(spark, sf_dir: str) -> dict[str, float]:
    """Retrieval, answer, forecast and neighbours over tables that are stored beforehand, for one question and for all."""
    t, s = TableFolder(spark, shared_folder(spark, "bench")), Settings()
    t.insert("text_chunks", I.document_chunks(spark, sf_dir))
    t.insert("text_emb", I.document_embeddings(spark, sf_dir).selectExpr("chunk_id", "'hashed' as model_id", "vector", "768L as vector_dim").filter("vector is not null"))
    t.insert("image_desc", I.page_captions(spark, sf_dir))
    t.upsert("kpi_series", I.kpi_series(spark, sf_dir))
    probed = Settings(probes=8)
    refresh_index(t, probed)
    everything = I.questions(spark, sf_dir)
    one = everything.filter("query_id = 'b0'")
    hot = I.question_vectors(spark, sf_dir)
    paths = {
        "stored_retrieval_one": lambda: context_for(t, s, one),
        "stored_retrieval_all": lambda: context_for(t, s, everything),
        "stored_retrieval_one_probed": lambda: context_for(t, probed, one),
        "stored_retrieval_all_probed": lambda: context_for(t, probed, everything),
        "stored_answer_one": lambda: synthesize_answers(one, context_for(t, s, one)),
        "stored_answer_all": lambda: synthesize_answers(everything, context_for(t, s, everything)),
        "stored_forecast": lambda: kpi.forecast(t.read("kpi_series")),
        "stored_neighbors": lambda: N.precompute_neighbors(t.read("text_emb"), hot, item_id="chunk_id"),
    }
    return {name: round(timed(make), 3) for name, make in paths.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM code paths and the Python workers before the clock runs.
    for name in ("context_topk", "forecast"):
        run(spark, name, sf_dir)
    times = {name: round(run(spark, name, sf_dir), 3) for name in names}
    if not wanted:
        times.update(stored_paths(spark, sf_dir))
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_wall_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

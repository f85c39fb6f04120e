"""The whole refresh on stored tables."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from evidex.operators import kpi
from evidex.operators.chunks import PDF_SUFFIX, extract_chunks
from evidex.operators.facts import FACT_SCHEMA
from evidex.operators.generate import generate_table
from evidex.plans import inputs as I
from evidex.plans.evidence import Settings, context_for, refresh, refresh_facts
from evidex.sources.tables import TABLES
from evidex.sources.writes import TableFolder


@pytest.fixture(scope="module")
def run(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("evidence"))
    tables = TableFolder(spark, root)
    orders = I.read(spark, sf_dir, "orders")
    today = I.last_day(orders, "o_orderdate")

    def go():
        refresh(
            tables, [I.document_chunks(spark, sf_dir)], I.questions(spark, sf_dir),
            [kpi.kpi_daily_counts(orders, "o_orderdate", "orders", today)], today,
            I.page_captions(spark, sf_dir), Settings(holdout=20, text_dim=64, image_dim=64),
        )
        return {r.table_name: r.n for r in tables.counts().collect()}

    return tables, go(), go()


def test_second_run_adds_nothing(run):
    _, first, second = run
    assert first == second


def test_tables_are_filled(run, spark, sf_dir):
    tables, counts, _ = run
    docs = I.document_chunks(spark, sf_dir).count()
    captions = I.page_captions(spark, sf_dir).filter("caption is not null").count()
    assert counts["text_chunks"] == docs + captions
    assert counts["hot_queries"] == counts["retrieval_gt"] == counts["metrics_retrieval"] == 20
    assert counts["precomputed_neighbors"] == 20 * 64 and counts["edges_semantic"] == 20 * 40
    assert counts["answers"] == I.questions(spark, sf_dir).count()
    assert counts["metrics_index_state"] == 2
    for name in ("facts_generic", "metrics_validators", "kpi_series", "kpi_forecast", "prompt_log", "image_emb"):
        assert counts[name] > 0, name


def test_keys_are_unique(run):
    tables = run[0]
    for name, spec in TABLES.items():
        df = tables.read(name)
        assert df.count() == df.select(*spec.keys).distinct().count(), name


def test_citations_are_sources_of_stored_chunks(run):
    tables = run[0]
    cited = tables.read("answers").select(F.explode("citations").alias("source_uri")).distinct()
    known = tables.read("text_chunks").select("source_uri")
    assert cited.count() > 0 and cited.join(known, "source_uri", "left_anti").count() == 0


def test_holdout_finds_itself_or_a_copy(run):
    # With the chunk itself in the base, a copy with a smaller id is the only thing that can be nearer.
    assert run[0].read("metrics_retrieval").agg(F.avg("mrr")).first()[0] > 0.8


def test_the_index_holds_every_vector_and_finds_the_context(run, spark, sf_dir):
    tables = run[0]
    cells, centers = tables.read_index("text_emb_idx")
    assert cells.count() == tables.read("text_emb").count() and len(centers) > 1
    questions = I.questions(spark, sf_dir)
    settings = Settings(text_dim=64)
    exact = context_for(tables, settings, questions)
    settings.probes = len(centers)
    assert sorted(map(str, exact.collect())) == sorted(map(str, context_for(tables, settings, questions).collect()))
    settings.probes = 2
    plan = context_for(tables, settings, questions)._jdf.queryExecution().toString()
    assert "PartitionFilters: [cast" in plan or "PartitionFilters: [cell" in plan or "PartitionFilters: [isnotnull(cell" in plan


def test_an_outage_loses_no_facts(spark, tmp_path):
    tables = TableFolder(spark, str(tmp_path))
    rows = [(f"c{i}", f"u{i}", f"Entity {i}", "en", (0, 5)) for i in range(40)]
    tables.insert("text_chunks", spark.createDataFrame(rows, TABLES["text_chunks"].columns))

    def broken():
        def model(records):
            raise ConnectionError("down")

        return model

    def working():
        fact = {"predicate": "p", "value_text": "1", "value_number": 1.0, "value_date": None, "confidence": 0.9, "source_span": None}
        return lambda records: [{"entity": r["text"], **fact} for r in records]

    def asked(make, **mode):
        return Settings(fact_model=lambda df: generate_table(df, make, ["text"], FACT_SCHEMA, **mode))

    refresh_facts(tables, asked(broken, on_error="null"))
    assert tables.read("facts_generic").count() == 0 and tables.read("prompt_log").count() == 0
    with pytest.raises(Exception, match="down"):
        refresh_facts(tables, asked(broken))
    refresh_facts(tables, asked(working))
    refresh_facts(tables, asked(broken))
    assert tables.read("facts_generic").count() == 40 and tables.read("prompt_log").count() == 40


def test_models_are_asked_once_and_new_evidence_gives_new_answers(spark, tmp_path):
    tables, asked = TableFolder(spark, str(tmp_path)), spark.sparkContext.accumulator(0)

    def counting(make):
        def model(records):
            asked.add(len(records))
            return [make(r) for r in records]

        return lambda: model

    caption = counting(lambda r: {"caption": r["object_uri"], "dominant_colors": [], "width_px": None, "height_px": None})
    answer = counting(lambda r: {"summary": r["context_text"], "citations": [], "confidence": 0.5, "validators": None})
    settings = Settings(
        text_dim=16, image_dim=16, holdout=1, search_k=2, neighbor_k=2,
        caption_model=lambda df: generate_table(df, caption, ["object_uri"], "caption string, dominant_colors array<string>, width_px bigint, height_px bigint"),
        answer_model=lambda df: generate_table(df, answer, ["context_text"], "summary string, citations array<string>, confidence double, validators array<struct<name: string, result: boolean, note: string>>"),
    )
    images = spark.createDataFrame([("red car",), ("blue boat",)], "object_uri string")
    questions = spark.createDataFrame([("q1", "which car?")], "query_id string, query string")
    objects = spark.createDataFrame([("doc", "a car of the year")], "object_uri string, text string")
    daily = spark.createDataFrame([], "kpi_id string, ts date, value double, tags array<string>")

    def go(*more):
        before = asked.value
        extra = spark.createDataFrame(list(more), "object_uri string, text string")
        step = lambda done: extract_chunks(objects.union(extra), PDF_SUFFIX, done=done)
        refresh(tables, [step], questions, [daily], date(2024, 1, 1), settings=settings, images=images)
        return asked.value - before

    assert go() == 3
    assert go() == 0
    assert go(("new", "a car which is new")) == 1
    assert tables.read("answers").count() == 2 and tables.read("image_desc").count() == 2
    assert tables.read("prompt_log").filter("prompt_id = 'captions_v1'").count() == 2

"""Chunks, embeddings, facts, models, validators, retrieval, answers and KPIs on hand-made rows."""

import math
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from evidex.operators import answers as A
from evidex.operators import kpi
from evidex.operators import retrieval as R
from evidex.operators import validators as V
from evidex.operators.chunks import PDF_SUFFIX, extract_chunks, html_text, html_title, pending, prompt_log
from evidex.operators.embed import embed_missing, hashed_embedding
from evidex.operators.facts import FACT_SCHEMA, extract_facts
from evidex.operators.generate import generate_bool, generate_double, generate_table


# Chunks


def test_chunks_drop_missing_text_and_span_the_whole(spark):
    df = spark.createDataFrame([("u1", "añb"), ("u2", None), ("u3", ""), ("u4", "x" * 30000)], "object_uri string, text string")
    rows = {r.source_uri: r for r in extract_chunks(df, PDF_SUFFIX).collect()}
    assert set(rows) == {"u1", "u4"}
    assert rows["u1"].span.offset_end == 3 and rows["u4"].span.offset_end == 30000
    assert extract_chunks(df, "#img").first().chunk_id != rows["u1"].chunk_id


def test_chunks_from_a_plugged_in_model(spark):
    def reader():
        return lambda records: [{"text": r["object_uri"].upper()} for r in records]

    def extractor(df):
        return generate_table(df, reader, ["object_uri"], "text string").withColumn("text", F.col("out.text"))

    df = spark.createDataFrame([("u1",)], "object_uri string")
    assert extract_chunks(df, PDF_SUFFIX, extractor=extractor).first().text == "U1"


def test_html(spark):
    page = "<html><title>A\nb</title><style>p{}</style><!-- x -->\n<p>one<br>two</p><script>var t='</p>';</script>"
    df = spark.createDataFrame([(page,), ("<title></title>",)], "html string")
    rows = df.select(html_text("html").alias("t"), html_title("html").alias("h")).collect()
    assert rows[0].t == "A b one two" and rows[0].h == "A\nb"
    assert rows[1].t == "" and rows[1].h is None


def test_prompt_log_repeats_its_ids(spark):
    df = spark.createDataFrame([("c1", "x"), ("c2", "y")], "chunk_id string, text string")
    a = prompt_log(df, "p", "v", "m", "text", "chunk_id").collect()
    assert a == prompt_log(df, "p", "v", "m", "text", "chunk_id").collect()
    assert len({r.call_id for r in a}) == 2 and all(len(r.input_hash) == 64 for r in a)


# Embeddings


def test_hashed_embedding(spark):
    df = spark.createDataFrame([("a", "one two two"), ("b", "..."), ("c", None), ("d", "TWO one two")], "k string, t string")
    rows = {r.k: r.vector for r in hashed_embedding(df, "k", "t", 32).collect()}
    assert rows["b"] is None and rows["c"] is None
    assert math.isclose(np.linalg.norm(rows["a"]), 1.0) and rows["a"] == rows["d"]
    assert sorted(x for x in rows["a"] if x) == pytest.approx([1 / math.sqrt(5), 2 / math.sqrt(5)])


def test_embed_missing_only_takes_new_rows(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", None), ("d", "--"), ("e", "z")], "k string, t string")
    done = spark.createDataFrame([("a",)], "k string")
    made = embed_missing(rows, done, "k", "t", 16)
    assert sorted(r.k for r in made.collect()) == ["b", "e"]
    assert made.first().vector_dim == 16
    assert "LeftAnti" in made._jdf.queryExecution().optimizedPlan().toString()


# Models and facts


def flaky_model():
    def one(r):
        if r["t"] == "bad":
            raise ValueError("no")
        return None if r["t"] == "none" else {"n": len(r["t"]), "tags": [{"name": r["t"], "ok": True}]}

    return lambda records: [one(r) for r in records]


def test_generate_table_keeps_going(spark):

    df = spark.createDataFrame([(i, t) for i, t in enumerate(["ab", "bad", "none", "c"])], "id int, t string").coalesce(1)
    schema = "n bigint, tags array<struct<name: string, ok: boolean>>"
    rows = generate_table(df, flaky_model, ["t"], schema, on_error="null").orderBy("id").collect()
    assert [r.out and r.out.n for r in rows] == [2, None, None, 1]
    assert [r.out_error for r in rows] == [None, "ValueError: no", None, None]
    assert rows[0].out.tags[0].name == "ab" and rows[0].out.tags[0].ok is True
    with pytest.raises(Exception):
        generate_table(df, flaky_model, ["t"], "n bigint").collect()


def test_generate_table_passes_columns_untouched(spark):
    big = 9007199254740993
    df = spark.createDataFrame([(big, "a", datetime(2024, 1, 1)), (None, "b", None)], "n bigint, t string, ts timestamp").coalesce(1)
    made = generate_table(df, flaky_model, ["t"], "n bigint, tags array<struct<name: string, ok: boolean>>")
    assert {(r.n, r.t, r.ts) for r in made.collect()} == {(big, "a", datetime(2024, 1, 1)), (None, "b", None)}


def test_one_model_per_task(spark):
    def make():
        calls = []

        def model(records):
            calls.extend(records)
            return [{"result": float(len(calls))} for _ in records]

        return model

    df = spark.range(10, numPartitions=1)
    assert {r.result for r in generate_double(df, make, ["id"]).collect()} == {10.0}
    yes = generate_bool(df, lambda: lambda rs: [{"result": r["id"] > 3} for r in rs], ["id"])
    assert yes.filter("result").count() == 6


def chunk_table(spark, texts):
    df = spark.createDataFrame([(f"u{i}", t) for i, t in enumerate(texts)], "object_uri string, text string")
    return extract_chunks(df, PDF_SUFFIX)


def test_facts(spark):
    late = "w " * 5000 + "Zed 77"
    chunks = chunk_table(spark, ["Acme paid 12.5 on 2024-02-03.", "acme paid 1", "Acme said so", "Acme on 2024-02-30", late])
    rows = {r.source_uri: r for r in extract_facts(chunks).collect()}
    assert set(rows) == {"u0", "u3", "u4"}
    assert (rows["u0"].subject, rows["u0"].object_number, rows["u0"].object_date) == ("Acme", 12.5, date(2024, 2, 3))
    assert rows["u0"].confidence == 1.0 and rows["u3"].object_date is None
    assert (rows["u4"].subject, rows["u4"].object_number) == ("Zed", 77.0)


def test_facts_of_a_model_and_done_ones(spark):
    confidences = [0.65, 0.64, None, 1.7]

    def make():
        return lambda rs: [
            {"entity": None if r["text"] == "t3" else "E", "predicate": "p", "value_date": "bad", "confidence": confidences[int(r["text"][1])]}
            for r in rs
        ]

    chunks = chunk_table(spark, ["t0", "t1", "t2", "t3"])
    facts = extract_facts(chunks, lambda df: generate_table(df, make, ["text"], FACT_SCHEMA), key="span")
    assert [(r.fact_id, r.confidence) for r in facts.collect()] == [("u0#0-2", 0.65)]
    assert extract_facts(chunks, F.struct(F.lit("E").alias("entity"), F.lit("p").alias("predicate"), F.lit(None).cast("string").alias("value_text"), F.lit(1.0).alias("value_number"), F.lit(None).cast("string").alias("value_date"), F.lit(0.9).alias("confidence")), done=facts, key="span").count() == 3


# Validators


def test_checks_skip_done_ones_and_cap_copies(spark):
    rows = spark.createDataFrame([(f"i{n % 3}", n) for n in range(30)], "id string, n int")
    done = spark.createDataFrame([("i0", "r"), ("i1", "other")], "item_id string, rule_id string")
    out = V.run_bool_validator(rows, "r", "id", F.col("n") > 10, done=done, tiebreak=["n"])
    assert {r.item_id: r["count"] for r in out.groupBy("item_id").count().collect()} == {"i1": 5, "i2": 5}


def test_tolerance_edges(spark):
    rows = [("a", 0.0, 0.0), ("b", 0.1, 0.0), ("c", -98.0, -100.0), ("d", -97.0, -100.0), ("e", None, 1.0), ("f", 1.0, None), ("g", 102.0, 100.0)]
    df = spark.createDataFrame(rows, "id string, x double, ref double")
    out = {r.item_id: r.result_bool for r in V.run_tolerance_validator(df, "t", "id", F.col("x"), "ref").collect()}
    assert out == {"a": True, "b": False, "c": True, "d": False, "e": None, "f": None, "g": True}
    signed = V.run_tolerance_validator(df, "t", "id", F.col("x"), "ref", signed=True)
    assert {r.item_id: r.result_bool for r in signed.collect()}["c"] is False
    assert out and signed.first().note == "tolerance=0.02"


def test_words(spark):
    df = spark.createDataFrame([("1", "A red Widget-9"), ("2", "widgets"), ("3", None)], "image_id string, caption string")
    assert [r.result_bool for r in V.brand_model_match(df, ["widget"]).orderBy("item_id").collect()] == [True, False, None]


def test_coverage_and_rollup(spark):
    rows = [("a", "r1", True, "n2"), ("b", "r1", None, "n1"), ("a", "r2", False, None), ("b", "r2", True, None), ("a", "r3", None, None)]
    df = spark.createDataFrame(rows, "item_id string, rule_id string, result_bool boolean, note string")
    assert {r.rule_id: (r.n, r.pass_rate) for r in V.validator_coverage(df).collect()} == {"r1": (2, 1.0), "r2": (2, 0.5), "r3": (1, None)}
    found = V.validator_rollup(df).first().validators
    assert [(v.name, v.result, v.note) for v in found] == [("r1", True, "n1"), ("r2", False, None), ("r3", None, None)]
    assert V.validator_rollup(df.limit(0)).first().validators is None


# Retrieval


def test_retrieval_metrics_edges(spark):
    preds = spark.createDataFrame(
        [("q1", "a", 1), ("q1", "b", 2), ("q2", "x", 1), ("q2", "c", 4), ("q3", "z", 1), ("q4", "a", 5)], "query_id string, item_id string, rank int"
    )
    truth = spark.createDataFrame(
        [("q1", "a"), ("q1", "b"), ("q1", "m"), ("q2", "c"), ("q5", "a"), ("q4", "a")], "query_id string, item_id string"
    )
    for few in (False, True):
        rows = {r.query_id: r for r in R.retrieval_metrics(preds, truth, 4, few).collect()}
        assert set(rows) == {"q1", "q2", "q4", "q5"}
        assert (rows["q1"].recall_k, rows["q1"].precision_k, rows["q1"].mrr) == (2 / 3, 0.5, 1.0)
        assert (rows["q2"].recall_k, rows["q2"].precision_k, rows["q2"].mrr) == (1.0, 0.25, 0.25)
        assert rows["q4"].mrr == rows["q5"].recall_k == 0.0
    mean = R.retrieval_metrics_mean(R.retrieval_metrics(preds, truth, 4)).first()
    assert mean.k == 4 and mean.mrr == pytest.approx(1.25 / 4)


def test_holdout_is_one_ordered_set(spark):
    chunks = spark.createDataFrame([(f"c{i}", f"word{i}") for i in range(9)], "chunk_id string, text string").repartition(4)
    known = hashed_embedding(chunks.filter("chunk_id < 'c2'"), "chunk_id", "text", 8)
    rows = R.make_holdout(chunks, known, 4, lambda d, k, t: hashed_embedding(d, k, t, 8)).orderBy("query_id").collect()
    assert [(r.query_id, r.item_id, r.query_text) for r in rows] == [(f"hq_{i + 1}", f"c{i}", f"word{i}") for i in range(4)]
    assert all(len(r.vector) == 8 for r in rows)


def test_fallback_fills_free_places_with_recent_captions(spark):
    questions = spark.createDataFrame([("q1",), ("q2",), ("q3",)], "query_id string")
    primary = spark.createDataFrame(
        [("q1", "p1", "t1", 1), ("q1", "p2", "t2", 2), *[("q2", f"s{i}", "t", i) for i in range(1, 6)]],
        "query_id string, source_uri string, text string, rank int",
    )
    captions = spark.createDataFrame([("old", "c-old", 1), ("new", "c-new", 9), ("none", None, 10)], "source_uri string, caption string, created_ts int")
    rows = R.context_with_fallback(questions, primary, captions, 4).orderBy("query_id", "rank").collect()
    by = {q: [(r["rank"], r.source_uri, r.is_primary) for r in rows if r.query_id == q] for q in ("q1", "q2", "q3")}
    assert by["q1"] == [(1, "p1", True), (2, "p2", True), (3, "new", False), (4, "old", False)]
    assert by["q2"] == [(i, f"s{i}", True) for i in range(1, 5)]
    assert by["q3"] == [(1, "new", False), (2, "old", False)]


# Answers


@pytest.fixture(scope="module")
def asked(spark):
    questions = spark.createDataFrame([("q1", "red fox"), ("q2", "nothing here"), ("q3", "lonely")], "query_id string, query string")
    contexts = spark.createDataFrame(
        [("q1", "u1", "a red\nfox", 1), ("q1", "u2", "fox red, again", 2), ("q1", "u3", "red", 3), ("q2", "u4", "else", 1)],
        "query_id string, source_uri string, text string, rank int",
    )
    return questions, contexts


def test_extractive_answers(asked):
    rows = {r.query_id: r for r in A.synthesize_answers(*asked).collect()}
    assert (rows["q1"].summary, rows["q1"].citations, rows["q1"].confidence) == ("a red fox", ["u1", "u2"], 1.0)
    assert (rows["q2"].summary, rows["q2"].citations, rows["q2"].confidence) == ("", [], 0.0)
    assert (rows["q3"].summary, rows["q3"].citations, rows["q3"].confidence) == ("", [], None)


def test_model_cannot_cite_other_sources(spark, asked):
    def make():
        return lambda rs: [
            {"summary": r["prompt_version"], "citations": ["u9", "u2", "u1", "u2"], "confidence": 1.7, "validators": [{"name": "m", "result": True, "note": None}]}
            for r in rs
        ]

    def model(df):
        return generate_table(df, make, ["query", "context_text", "prompt_version"], A.ANSWER_SCHEMA)

    rows = {r.query_id: r for r in A.synthesize_answers(*asked, model=model).collect()}
    assert rows["q1"].citations == ["u2", "u1", "u2"] and rows["q1"].confidence == 1.0
    assert rows["q3"].citations == [] and rows["q1"].validators[0].name == "m"
    assert {r.summary for r in rows.values()} <= {"answer_v1", "answer_v2"}
    checks = spark.createDataFrame([("a", "r1", True, None)], "item_id string, rule_id string, result_bool boolean, note string")
    ruled = A.synthesize_answers(*asked, model=model, rollup=V.validator_rollup(checks))
    assert all(r.validators[0].name == "r1" for r in ruled.collect())
    plan = ruled._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_context_holds_at_most_k_snippets(asked):
    rows = {r.query_id: r for r in A.answer_inputs(*asked, k=2).collect()}
    assert rows["q1"].context_text == "a red fox\n- fox red, again" and rows["q1"].allowed_uris == ["u1", "u2"]
    assert rows["q3"].allowed_uris is None


# KPIs


def line(kpi_id, n, slope=1.0, start=date(2024, 1, 1), step=1):
    return [(kpi_id, start + timedelta(days=i * step), 10.0 + slope * i * step) for i in range(n)]


@pytest.fixture(scope="module")
def series(spark):
    rows = line("two", 2) + line("three", 3) + line("flat", 10, 0.0) + line("gaps", 6, 2.0, step=3)
    rng = np.random.default_rng(3)
    rows += [("noisy", date(2024, 1, 1) + timedelta(days=i), float(v)) for i, v in enumerate(rng.normal(5, 1, 40))]
    return spark.createDataFrame(rows + [("three", None, 5.0)], "kpi_id string, ts date, value double")


def test_forecast(series):
    rows = kpi.forecast(series).collect()
    by = {k: sorted((r for r in rows if r.kpi_id == k), key=lambda r: r.ts) for k in {r.kpi_id for r in rows}}
    assert set(by) == {"three", "flat", "gaps", "noisy"} and all(len(v) == 30 for v in by.values())
    assert by["three"][0].ts == date(2024, 1, 4) and by["three"][0].predicted == pytest.approx(13.0)
    assert by["flat"][29].predicted == by["flat"][29].upper == pytest.approx(10.0)
    assert by["gaps"][0].predicted == pytest.approx(10 + 2 * 16)
    width = [r.upper - r.lower for r in by["noisy"]]
    assert width == sorted(width) and width[0] > 0
    assert len({r.run_id for r in rows}) == 4


def test_backtest_equals_refits(spark, series):
    rows = kpi.forecast_backtest(series).collect()
    for split in {r.split_ts for r in rows if r.kpi_id == "noisy"}:
        alone = kpi.forecast(series.filter((F.col("kpi_id") == "noisy") & (F.col("ts") <= F.lit(split)))).collect()
        mine = {r.ts: r for r in rows if r.kpi_id == "noisy" and r.split_ts == split}
        assert len(alone) == len(mine) == 30
        assert all(mine[a.ts].predicted == pytest.approx(a.predicted) and mine[a.ts].upper == pytest.approx(a.upper) for a in alone)
    assert len({r.split_ts for r in rows if r.kpi_id == "noisy"}) == 3
    assert {r.kpi_id for r in rows if r.actual is not None} >= {"noisy", "flat"}


def test_reports(series):
    made = kpi.forecast(series)
    everything = made.unionByName(kpi.forecast_backtest(series).select(made.columns))
    assert kpi.kpi_cards(everything).count() == 100
    one = {r.kpi_id: r for r in kpi.forecast_summary(everything).collect()}["gaps"]
    assert (one.rows_prod, one.min_ts, one.max_ts) == (30, "2024-01-17", "2024-02-15")
    assert one.p25 < one.p50 < one.p75
    assert [r.ts for r in kpi.forecast_preview(everything, "gaps", 2).collect()] == [date(2024, 1, 17), date(2024, 1, 18)]


def test_series_from_facts(spark):
    rows = [(date(2024, 1, 1), 0.1), (date(2024, 1, 1), 0.2), (None, 1e30), (None, 5.0), (date(2024, 1, 2), None)]
    facts = spark.createDataFrame(rows, "object_date date, object_number double")
    found = {r.ts: r.value for r in kpi.kpi_from_facts(facts, date(2024, 2, 1)).collect()}
    assert found == {date(2024, 1, 1): 0.3, date(2024, 1, 2): 0.0, date(2024, 2, 1): 1e30}


def test_daily_counts_window(spark):
    df = spark.sql("select explode(sequence(timestamp'2024-01-01 10:00:00', timestamp'2024-07-10 10:00:00', interval 1 day)) as ts")
    out = kpi.kpi_daily_counts(df, "ts", "k", date(2024, 7, 10), 180)
    assert out.count() == 181 and out.agg(F.min("ts")).first()[0] == date(2024, 1, 12)


def test_pending(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    assert [r.k for r in pending(a, a.filter("k = 1"), "k").collect()] == [2]

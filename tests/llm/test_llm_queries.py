"""The registered queries and the pipeline over the small tables."""

import pytest
from compare import difference, oracle_connection
from conftest import SF_DIR
from pyspark.sql import functions as F

import corpus_pipeline
from evidex.llm.oracles import ORACLES
from evidex.llm.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", ["op3_tokens", "op5_quality", "op6_bpe", "op8_mix", "op10_toxicity", "op13_winnowing"])
def test_every_row_has_its_result(spark, name):
    ids = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect()}
    found = [r.doc_id for r in QUERIES[name](spark, SF_DIR).select("doc_id").collect()]
    assert len(found) == len(ids) and set(found) == ids


def test_operators_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_stages_hand_on_documents(spark):
    """Each stage against what its operator says of the rows that came in."""
    from evidex.llm import minhash, mixing, quality, substrings

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").cache()
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "near-duplicates", "repeated passages", "mixing sources", "byte-level BPE"]
    kept = stages["quality rules"](spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    wanted = {r.doc_id for r in quality.judge(docs).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == wanted
    one = stages["near-duplicates"](spark, docs, SF_DIR)
    assert one.columns == docs.columns
    assert {r.doc_id for r in one.collect()} == {r.doc_id for r in minhash.link(docs).filter("kept").collect()}
    cut = stages["repeated passages"](spark, docs, SF_DIR)
    assert cut.columns == docs.columns
    left = {r.doc_id: r.text for r in substrings.remove_repeats(docs).filter("n_words > n_removed").collect()}
    assert {r.doc_id: r.text for r in cut.collect()} == left and cut.filter(F.length("text") != F.col("n_chars")).count() == 0
    mixed = stages["mixing sources"](spark, docs, SF_DIR)
    assert mixed.columns == docs.columns
    times = {r.row_id: int(r.taken / r.size + 0.5) for r in mixing.mix(docs).collect() if r.size}
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {i: n for i, n in times.items() if n}
    docs.unpersist()


def test_stages_take_odd_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, extra string"
    text = " ".join(f"w{i}" for i in range(50)) + "."
    rows = [(1, text, None, None, None, "x"), (1, text, None, None, None, "x"), (2, None, "en", "s", 0, "y"), (None, "", None, "s", 0, None), (None, text + " more", "en", "t", 1, None)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SF_DIR).columns == corpus_pipeline.DOCUMENTS
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == docs.count()
    near = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, schema), SF_DIR).collect()
    assert sorted(r.doc_id or 0 for r in near) == [0, 0, 1, 2]


def test_the_whole_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.columns == ["doc_id", "ids", "n_tokens"] and out.count() > 0
    assert out.filter(F.size("ids") != F.col("n_tokens")).count() == 0

"""No registered query plans a cross join or a nested loop, and none reads columns it does not need."""

import re
from datetime import date, datetime

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from evidex.operators.chunks import pending
from evidex.operators.facts import extract_facts
from evidex.operators.kpi import kpi_daily_counts
from evidex.plans.inputs import document_chunks, read
from evidex.plans.registered import QUERIES
from evidex.sources.writes import purge_expired

RUNS_JOBS = {"stored_run_counts", "stream_daily_counts", "stream_chunks"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - RUNS_JOBS))
def test_no_cross_join(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "NestedLoop" not in plan
    assert "BatchEvalPython" not in plan


def test_scans_are_narrow(spark):
    plan = QUERIES["kpi_daily_counts"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in plan
    plan = QUERIES["vector_topk"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "label" not in plan.split("ReadSchema")[1]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_filters_reach_the_files(spark):
    orders = read(spark, SF_DIR, "orders")
    counts = kpi_daily_counts(orders, "o_orderdate", "orders", date(2001, 8, 1))
    assert "GreaterThanOrEqual(o_orderdate,2001-02-02T00:00)" in plan_of(counts)
    events = read(spark, SF_DIR, "events")
    now = F.lit(datetime(2024, 1, 20, 12))
    assert "GreaterThan(ts,2024-01-20T10:59)" in plan_of(purge_expired(events, "ts", now))


def test_each_pattern_is_matched_once_per_row(spark):
    """The filters on facts stand above the generator that keeps the matches."""
    plan = plan_of(extract_facts(document_chunks(spark, SF_DIR)))
    assert plan.count("regexp_extract(") == 3
    assert plan.index("Filter") < plan.index("Generate") < plan.index("regexp_extract(")


def test_rule_outcomes_do_not_sort_all_rows(spark):
    plan = plan_of(QUERIES["validator_rollup"](spark, SF_DIR))
    assert re.search(r"HashAggregate\(keys=\[rule_id#\d+, note#\d+\], functions=\[partial_", plan)
    # The only sorted aggregate is over rows already reduced to one per rule and note.
    assert "HashAggregate(keys=" in plan[plan.rindex("SortAggregate"):]


def test_pending_is_one_anti_join(spark):
    docs = read(spark, SF_DIR, "documents")
    todo = pending(docs, docs.filter("doc_id > 3").select("doc_id"), "doc_id")
    assert sorted(r.doc_id for r in todo.collect()) == [0, 1, 2, 3]
    plan = plan_of(todo)
    assert "LeftAnti" in plan and "LeftSemi" not in plan


def test_null_keys_stay_pending_however_many_rows_do(spark):
    rows = spark.createDataFrame([(None,), (1,), (2,)], "k int")
    for done in ([(1,)], [(1,), (2,)], [(None,)], []):
        known = spark.createDataFrame(done, "k int")
        left = [r.k for r in pending(rows, known, "k").collect()]
        assert None in left and set(left) - {None} == {1, 2} - {d[0] for d in done}

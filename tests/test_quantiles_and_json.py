"""Quantile sketches against exact ranks; values out of JSON texts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from evidex.functions.json import json_columns, json_schema, json_value, json_variant
from evidex.operators import quantiles as Q
from evidex.operators.answers import answer_rules

VALUES = "kpi_id string, run_id int, value double"


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(5)
    rows = [("even", i % 7, float(v)) for i, v in enumerate(rng.permutation(20_000))]
    rows += [("skewed", i % 3, float(v)) for i, v in enumerate(rng.lognormal(0, 3, 9_000))]
    rows += [("ties", 0, float(i % 4)) for i in range(5_000)] + [("few", i, float(i)) for i in range(11)]
    rows += [("few", 0, None), ("few", 0, float("nan")), ("few", 1, float("inf")), ("none", 1, None), (None, 1, 2.0)]
    return spark.createDataFrame(rows, VALUES).repartition(6)


def test_merged_sketches_are_within_the_rank_error(values):
    finite = values.filter("value is not null and not isnan(value) and value < 1e300")
    merged = Q.merge_sketches(Q.value_sketches(values, ["kpi_id", "run_id"]), ["kpi_id"])
    fractions = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
    errors = Q.rank_errors(finite, merged, ["kpi_id"], fractions).collect()
    assert {(r.kpi_id, r.n) for r in errors} == {("even", 20_000), ("skewed", 9_000), ("ties", 5_000), ("few", 11)}
    assert len(errors) == 4 * len(fractions) and all(r.rank_error <= Q.RANK_ERROR for r in errors)
    assert all(r.rank_error == 0 for r in errors if r.kpi_id in ("ties", "few"))


def test_small_groups_are_exact_and_groups_without_values_have_no_row(values):
    made = Q.quantiles(Q.merge_sketches(Q.value_sketches(values, ["kpi_id", "run_id"]), ["kpi_id"]), (0, 0.5, 1), ("low", "mid", "high"))
    found = {r.kpi_id: (r.n, r.low, r.mid, r.high) for r in made.collect()}
    assert found["few"] == (11, 0.0, 5.0, 10.0) and found[None] == (1, 2.0, 2.0, 2.0) and "none" not in found
    assert found["even"][1] == 0.0 and found["even"][3] == 19_999.0
    assert Q.value_sketches(values.limit(0), ["kpi_id"]).count() == 0


def test_a_sketch_stays_small(spark):
    sizes = [Q.value_sketches(spark.range(n), [], "id").select(F.length("sketch")).first()[0] for n in (10_000, 300_000)]
    assert sizes[1] < 1.6 * sizes[0] < 20_000


def test_new_runs_are_merged_with_stored_ones(spark, values, tmp_path):
    Q.value_sketches(values.filter("run_id < 3"), ["kpi_id"]).write.parquet(str(tmp_path / "s"))
    old = spark.read.parquet(str(tmp_path / "s"))
    both = Q.union_sketches([old, Q.value_sketches(values.filter("run_id >= 3"), ["kpi_id"])], ["kpi_id"])
    assert {r.kpi_id: r.n for r in both.collect()} == {"even": 20_000, "skewed": 9_000, "ties": 5_000, "few": 11, None: 1}


def test_summary_of_forecast_runs(spark):
    rows = [("a", "r1", f"2024-01-{d:02}", float(d), False) for d in range(1, 9)] + [("a", "r2", f"2024-02-{d:02}", 100.0 + d, False) for d in range(1, 9)]
    rows += [("a", "b1", "2025-01-01", 5.0, True)]
    made = spark.createDataFrame(rows, "kpi_id string, run_id string, ts string, predicted double, backtest boolean").withColumn("ts", F.to_date("ts"))
    got = Q.forecast_summary(Q.forecast_sketches(made)).collect()
    assert [tuple(r) for r in got] == [("a", 16, "2024-01-01", "2024-02-08", 4.0, 8.0, 104.0)]


# JSON

TEXTS = [
    ('{"k": 7, "s": "x", "a": [1, {"b": 2.5}], "n": null}', True), ('{"k": "7"}', True), ('{"k": 1e3}', True), ("[]", True), ("3", True), ("null", True),
    ("{broken", False), ("", False), (None, False), ('{"k": 99999999999999999999}', True), ('{"k": true, "k2": 1}', True),
]


def test_values_and_broken_texts(spark):
    df = spark.createDataFrame([(i, t, "clash") for i, (t, _) in enumerate(TEXTS)], "id int, props string, k string").drop("k")
    made = json_columns(df, "props", {"k": ("$.k", "bigint"), "s": ("$.s", "string"), "b": ("$.a[1].b", "double"), "n": ("$.n", "string")}, "ok")
    rows = made.orderBy("id").collect()
    assert [r.ok for r in rows] == [ok for _, ok in TEXTS]
    assert [r.k for r in rows] == [7, 7, 1000, None, None, None, None, None, None, None, 1]
    assert (rows[0].s, rows[0].b, rows[0].n) == ("x", 2.5, None) and made.columns == ["id", "props", "k", "s", "b", "n", "ok"]


def test_schema_of_a_group(spark):
    df = spark.createDataFrame([("a", '{"k": 1}'), ("a", '{"k": 2.5, "x": "y"}'), ("a", "{no"), ("b", None)], "g string, props string")
    rows = {r.g: (r.n, r.n_valid, r.schema) for r in json_schema(df, "props", "g").collect()}
    assert rows["a"][:2] == (3, 2) and "k: " in rows["a"][2] and "x: STRING" in rows["a"][2] and rows["b"][:2] == (1, 0)


def test_a_text_is_parsed_once(spark, tmp_path):
    spark.createDataFrame([('{"a": 1, "b": 2}',)], "props string").write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    made = json_columns(df, "props", {"a": ("$.a", "int"), "b": ("$.b", "int")}, "ok")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert made.first()[1:] == (1, 2, True)
    assert plan.lower().count("parsejson") == 1


def test_rules_of_an_answer_as_json(spark):
    schema = "answer_id string, validators array<struct<name: string, result: boolean, note: string>>"
    rows = [("x", [("r1", True, None), ("r2", False, 'say "no"'), ("r3", None, None)]), ("y", []), ("z", None)]
    found = {r.answer_id: r for r in answer_rules(spark.createDataFrame(rows, schema)).collect()}
    assert (found["x"].n_rules, found["x"].failed) == (3, "r2")
    assert found["x"].validators_summary == '[{"name":"r1","result":true},{"name":"r2","result":false,"note":"say \\"no\\""},{"name":"r3"}]'
    assert (found["y"].n_rules, found["y"].failed, found["y"].validators_summary) == (0, "", "[]") and found["z"].validators_summary is None


def test_values_by_path(spark):
    row = spark.createDataFrame([('{"a": {"b": [10, 20]}}',)], "t string").select(
        json_value(json_variant("t"), "$.a.b[1]", "int").alias("x"), json_value(json_variant("t"), "$.a.c").alias("y")
    ).first()
    assert tuple(row) == (20, None)

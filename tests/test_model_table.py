"""Models and readers as table functions of SQL."""

import pytest
from pyspark.sql import functions as F

from evidex.operators.generate import generate_table
from evidex.operators.model_table import register_model, register_reader

SCHEMA = "n bigint, parts array<string>, first struct<word: string, size: int>"


class Words:
    def __call__(self, records):
        found = [(r["text"] or "").split() for r in records]
        if any("bad" in w for w in found):
            raise ValueError("bad word")
        return [{"n": len(w), "parts": w, "first": {"word": w[0], "size": len(w[0])}} if w else None for w in found]


@pytest.fixture(scope="module")
def rows(spark):
    texts = ["one two", "", None, "a b c", "one two", "bad one", "x"] + [f"text {i}" for i in range(200)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "id bigint, text string, n string").repartition(5)
    df.createOrReplaceTempView("rows_of_test")
    return df


def test_equals_generate_table(spark, rows):
    register_model(spark, "words_test", Words, ["text"], SCHEMA, batch_size=7)
    wanted = generate_table(rows, Words, ["text"], SCHEMA, on_error="null")
    for sql in ("table(rows_of_test)", "table(rows_of_test) partition by id % 3 order by id", "table(select * from rows_of_test where id < 50)"):
        found = spark.sql(f"select * from words_test({sql}, on_error => 'null')")
        assert found.columns == wanted.columns and found.dtypes == wanted.dtypes
        least = wanted.filter("id < 50") if "where" in sql else wanted
        assert sorted(map(str, found.collect())) == sorted(map(str, least.collect()))


def test_errors_stop_the_statement_unless_asked_for(spark, rows):
    register_model(spark, "words_test", Words, ["text"], SCHEMA)
    with pytest.raises(Exception, match="bad word"):
        spark.sql("select * from words_test(table(rows_of_test))").collect()
    assert spark.sql("select * from words_test(table(select * from rows_of_test where id < 0))").count() == 0


@pytest.mark.parametrize("call, message", [
    ("words_test(1)", "TABLE"), ("words_test(table(select id from rows_of_test))", "no columns"),
    ("words_test(table(select *, 1 as out from rows_of_test))", "exist already"), ("words_test(table(rows_of_test), 'maybe')", "on_error"),
])
def test_wrong_calls_are_told_when_planned(spark, rows, call, message):
    register_model(spark, "words_test", Words, ["text"], SCHEMA)
    with pytest.raises(Exception, match=message):
        spark.sql(f"select * from {call}")


class Longest:
    """The longest rise of a group's values, in their order."""

    def __init__(self):
        self.g, self.last, self.run, self.best = None, None, 0, 0

    def read(self, record):
        self.g = record["g"]
        self.run = self.run + 1 if self.last is not None and record["v"] > self.last else 1
        self.last, self.best = record["v"], max(self.best, self.run)

    def result(self):
        return [{"g": self.g, "best": self.best}]


def test_a_reader_sees_each_group_in_order(spark):
    register_reader(spark, "longest_test", Longest, ["g", "v"], "g string, best int")
    rows = [("a", i, (i * 7) % 10) for i in range(50)] + [("b", 1, 5), (None, 1, 2), (None, 2, 3)]
    df = spark.createDataFrame(rows, "g string, at int, v int").repartition(6)
    found = spark.sql("select * from longest_test(table({df}) partition by g order by at)", df=df).collect()
    wanted = {}
    for g in ("a", "b", None):
        values = [v for x, _, v in sorted((r for r in rows if r[0] == g), key=lambda r: r[1])]
        best = run = 1
        for a, b in zip(values, values[1:]):
            run = run + 1 if b > a else 1
            best = max(best, run)
        wanted[g] = best
    assert {r.g: r.best for r in found} == wanted and len(found) == 3
    none = spark.sql("select * from longest_test(table({df}) partition by g)", df=df.filter(F.lit(False)))
    assert none.count() == 0

"""Clustered tables: joins by the key need no exchange, inserts add only what is missing."""

import uuid

import pytest

from evidex.operators.chunks import pending
from evidex.sources.clustered import insert_clustered, open_clustered, write_clustered
from evidex.sources.writes import new_rows


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def made(spark, tmp_path, ids, value):
    name = f"t_{uuid.uuid4().hex}"
    df = spark.createDataFrame([(i, value) for i in ids], "id string, value string")
    write_clustered(df, name, str(tmp_path / name), ["id"], 4)
    return name, str(tmp_path / name)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_by_the_key_need_no_exchange(spark, tmp_path, no_broadcast):
    left, _ = made(spark, tmp_path, map(str, range(50)), "a")
    right, _ = made(spark, tmp_path, map(str, range(0, 50, 3)), "b")
    a, b = spark.table(left), spark.table(right)
    assert "Exchange" in plan(a.distinct().repartition(3))
    for df in (pending(a, b, "id"), new_rows(b, a, ["id"]), a.join(b, "id"), a.groupBy("id").count()):
        assert "Exchange" not in plan(df)
    assert {r.id for r in pending(a, b, "id").collect()} == {str(i) for i in range(50) if i % 3}


def test_an_insert_leaves_stored_files_alone_and_shuffles_only_its_source(spark, tmp_path, no_broadcast):
    name, path = made(spark, tmp_path, "abc", "old")
    before = {p.name for p in (tmp_path / name).glob("*.parquet")}
    source = spark.createDataFrame([("b", "new"), ("d", "new"), ("d", "new"), ("e", "new")], "id string, value string")
    for _ in range(2):
        rows = insert_clustered(source, name, path, ["id"], 4).collect()
        assert sorted((r.id, r.value) for r in rows) == [("a", "old"), ("b", "old"), ("c", "old"), ("d", "new"), ("e", "new")]
    assert before <= {p.name for p in (tmp_path / name).glob("*.parquet")}
    text = plan(pending(source, spark.table(name), "id"))
    assert text.count("Exchange hashpartitioning") == 1
    empty = insert_clustered(source.limit(0), name, path, ["id"], 4)
    assert empty.count() == 5


def test_a_table_of_an_earlier_session_is_opened_with_its_buckets(spark, tmp_path, no_broadcast):
    name, path = made(spark, tmp_path, "abcd", "old")
    again = open_clustered(spark, f"{name}_again", path, "id string, value string", ["id"], 4)
    assert "Exchange" not in plan(again.join(spark.table(name), "id")) and again.count() == 4
    write_clustered(spark.createDataFrame([("x", "new")], again.schema), f"{name}_again", path, ["id"], 4)
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == 5

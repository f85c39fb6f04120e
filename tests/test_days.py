"""Tables in a folder per day: which files a change touches."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from evidex.sources import days as D

START = datetime(2024, 5, 1)
SCHEMA = "id int, value double, ts timestamp, day date"


def rows_of(spark, items):
    return spark.createDataFrame(items, SCHEMA)


def files(path):
    return {p.parent.name: {q.name for q in p.parent.glob("*.parquet")} for p in path.glob("day=*/*.parquet")}


def event(i, hours, value=1.0):
    ts = START + timedelta(hours=hours)
    return (i, value, ts, ts.date())


@pytest.fixture
def table(spark, tmp_path):
    df = rows_of(spark, [event(i, 6 * i) for i in range(20)] + [(99, 9.0, None, None)])
    D.write_days(df, str(tmp_path / "t"), "day")
    return tmp_path / "t", df.schema


def test_an_upsert_rewrites_only_the_days_of_its_rows(spark, table):
    path, schema = table
    before = files(path)
    source = [event(1, 6, 5.0), event(50, 7, 6.0), event(50, 7, 6.0), event(60, 300, 7.0), (99, 8.0, None, None)]
    D.upsert_days(spark, str(path), rows_of(spark, source), ["id", "day"], "day")
    after = files(path)
    changed = {d for d in after if after[d] != before.get(d)}
    assert changed == {"day=2024-05-01", "day=2024-05-13", f"day={D.NULL_DAY}"}
    rows = D.read_days(spark, str(path), schema, "day").collect()
    values = {r.id: r.value for r in rows}
    assert len(rows) == 23 and values == {**{i: 1.0 for i in range(20)}, 1: 5.0, 50: 6.0, 60: 7.0, 99: 8.0}
    D.upsert_days(spark, str(path), rows_of(spark, source), ["id", "day"], "day")
    assert sorted(map(str, D.read_days(spark, str(path), schema, "day").collect())) == sorted(map(str, rows))
    with pytest.raises(ValueError):
        D.upsert_days(spark, str(path), rows_of(spark, source), ["id"], "day")


def test_a_purge_drops_whole_days_and_rewrites_one(spark, table):
    path, schema = table
    before = files(path)
    now = START + timedelta(days=3, hours=7)
    # One day and a minute: rows of 2 May 06:59 and before go.
    found = D.purge_days(spark, str(path), schema, "day", "ts", F.lit(now), 2 * 24 * 60)
    assert found == (["2024-05-01"], ["2024-05-02"])
    after = files(path)
    assert "day=2024-05-01" not in after
    assert {d for d in after if after[d] != before[d]} == {"day=2024-05-02"}
    kept = {r.id for r in D.read_days(spark, str(path), schema, "day").collect()}
    border = now - timedelta(minutes=2 * 24 * 60 + 1)
    assert kept == {i for i in range(20) if START + timedelta(hours=6 * i) > border} | {99}
    assert D.purge_days(spark, str(path), schema, "day", "ts", F.lit(now), 2 * 24 * 60) == ([], [])
    assert files(path) == after


def test_a_border_day_without_rows_left_goes_too(spark, table):
    path, schema = table
    gone, rewritten = D.purge_days(spark, str(path), schema, "day", "ts", F.lit(START + timedelta(days=30)), 0)
    assert len(gone) == 5 and rewritten == []
    assert [r.id for r in D.read_days(spark, str(path), schema, "day").collect()] == [99]


def test_border_day_whose_rows_all_expired(spark, tmp_path):
    df = rows_of(spark, [event(1, 1), event(2, 30)])
    D.write_days(df, str(tmp_path / "t"), "day")
    found = D.purge_days(spark, str(tmp_path / "t"), df.schema, "day", "ts", F.lit(START + timedelta(hours=3)), 60)
    assert found == (["2024-05-01"], [])


def test_nothing_written_yet_is_an_empty_table(spark, tmp_path):
    schema = rows_of(spark, []).schema
    path = str(tmp_path / "none")
    assert D.read_days(spark, path, schema, "day").count() == 0
    assert D.purge_days(spark, path, schema, "day", "ts", F.lit(START)) == ([], [])
    D.upsert_days(spark, path, rows_of(spark, [event(1, 0)]), ["id", "day"], "day")
    assert D.read_days(spark, path, schema, "day").first().day == date(2024, 5, 1)


def test_a_filter_on_the_day_opens_only_its_folder(spark, table):
    path, schema = table
    plan = D.read_days(spark, str(path), schema, "day").filter(F.col("day") == date(2024, 5, 2))
    assert "PartitionFilters: [isnotnull(day" in plan._jdf.queryExecution().executedPlan().toString()
    opened = {r[0].rsplit("/", 1)[1] for r in plan.select(F.input_file_name()).collect()}
    assert opened == files(path)["day=2024-05-02"]

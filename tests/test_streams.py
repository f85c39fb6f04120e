from datetime import datetime

from pyspark.sql import functions as F

from evidex.operators.chunks import PDF_SUFFIX, extract_chunks
from evidex.sources.writes import TableFolder
from evidex.streaming.daily import daily_counts, event_days, insert_stream, read_files_as_stream

EVENT = "event_id bigint, ts timestamp, kind string"


def write(spark, folder, rows):
    spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(folder)


def test_any_order_and_batching_gives_the_same_counts(spark, tmp_path):
    folder = str(tmp_path / "in")
    days = [datetime(2024, 1, d, 23, 30) for d in (4, 3, 2, 1)]
    for n, day in enumerate(days):
        write(spark, folder, [(10 * n, day, "a"), (10 * n, day, "a"), (10 * n + 1, day, "b"), (0, days[0], "a")])
    wanted = sorted([("a", str(d.date()), 1.0) for d in days] + [("b", str(d.date()), 1.0) for d in days])
    for per_batch in (1, 64):
        tables = TableFolder(spark, str(tmp_path / f"tables{per_batch}"))
        for state in ("s1", "s1"):
            stream = read_files_as_stream(spark, folder, "*.parquet", per_batch)
            insert_stream(stream, tables, "event_days", str(tmp_path / f"{state}{per_batch}"), lambda b: event_days(b, "ts", "kind", "event_id"))
        found = daily_counts(tables.read("event_days")).collect()
        assert sorted((r.kpi_id, str(r.ts), r.value) for r in found) == wanted


def test_a_table_that_is_a_folder_is_a_stream(spark, tmp_path):
    write(spark, str(tmp_path / "events.parquet"), [(1, datetime(2024, 1, 1), "a")])
    write(spark, str(tmp_path / "events.parquet"), [(2, datetime(2024, 1, 2), "b")])
    tables = TableFolder(spark, str(tmp_path / "tables"))
    stream = read_files_as_stream(spark, str(tmp_path), "events.parquet")
    insert_stream(stream, tables, "event_days", str(tmp_path / "state"), lambda b: event_days(b, "ts", "kind", "event_id"))
    assert tables.read("event_days").count() == 2


def test_replayed_files_add_nothing(spark, tmp_path):
    folder = str(tmp_path / "docs")
    spark.createDataFrame([("u1", "t1"), ("u2", "t2")], "object_uri string, text string").write.parquet(folder)
    tables = TableFolder(spark, str(tmp_path / "tables"))
    for state in ("s1", "s1", "s2"):
        stream = read_files_as_stream(spark, folder, "*.parquet")
        insert_stream(stream, tables, "text_chunks", str(tmp_path / state), lambda df: extract_chunks(df, PDF_SUFFIX))
    assert tables.read("text_chunks").count() == 2
    assert tables.read("text_chunks").select(F.countDistinct("chunk_id")).first()[0] == 2

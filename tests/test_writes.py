from datetime import datetime

import pytest
from pyspark.sql import functions as F

from evidex import session
from evidex.sources import writes as S
from evidex.operators.chunks import PDF_SUFFIX, extract_chunks
from evidex.sources.objects import list_objects, object_catalog, register_uris
from evidex.sources.tables import REWRITTEN, TABLES


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


def test_insert_if_absent_twice_adds_nothing(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "new"), (3, "c"), (3, "d"), (3, "c")], "k int, v string")
    once = S.insert_if_absent(target, source, ["k"])
    assert once.count() == 3 and (2, "b") in pairs(once)
    assert pairs(S.insert_if_absent(once, source, ["k"])) == pairs(once)
    assert "LeftAnti" in once._jdf.queryExecution().optimizedPlan().toString()


def test_choice_among_copies_of_a_key_does_not_depend_on_partitions(spark):
    rows = spark.range(300).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    assert pairs(S.one_per_key(rows.repartition(1), ["k"])) == pairs(S.one_per_key(rows.repartition(9, "v"), ["k"]))


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 10)], "k int, v string, made int")
    source = spark.createDataFrame([(2, "B", 20), (3, "c", 20)], "k int, v string, made int")
    assert pairs(S.upsert(target, source, ["k"])) == [(1, "a", 10), (2, "B", 20), (3, "c", 20)]
    kept = S.upsert(target, source, ["k"], keep=["made"])
    assert pairs(kept) == [(1, "a", 10), (2, "B", 10), (3, "c", 20)]


def test_purge_counts_whole_minutes(spark):
    now = datetime(2024, 5, 1, 12, 0, 0)
    rows = [
        (1, datetime(2024, 5, 1, 11, 0, 0)), (2, datetime(2024, 5, 1, 10, 59, 1)), (3, datetime(2024, 5, 1, 10, 59, 0)),
        (4, None), (5, datetime(2024, 5, 1, 13, 0, 0)),
    ]
    df = spark.createDataFrame(rows, "id int, ts timestamp")
    assert [r.id for r in S.purge_expired(df, "ts", F.lit(now)).orderBy("id").collect()] == [1, 2, 4, 5]


def test_catalog_is_distinct(spark):
    a = register_uris(spark, ["u1", "u2"], "image/jpeg")
    b = register_uris(spark, ["u2", "u3"], "image/jpeg")
    assert sorted(r.object_uri for r in object_catalog(a, b).collect()) == ["u1", "u2", "u3"]


def test_folder_inserts_by_key(spark, tmp_path):
    t = S.TableFolder(spark, str(tmp_path))
    assert t.read("text_chunks").count() == 0
    rows = spark.createDataFrame(
        [("c1", "u", "text", None, (0, 4))],
        "chunk_id string, source_uri string, text string, lang string, span struct<offset_start: bigint, offset_end: bigint>",
    )
    t.insert("text_chunks", rows)
    t.insert("text_chunks", rows)
    assert t.read("text_chunks").count() == 1
    assert t.read("text_chunks").first().span.offset_end == 4


def test_folder_tables_by_day(spark, tmp_path):
    t = S.TableFolder(spark, str(tmp_path), F.lit(datetime(2024, 5, 1, 12)))
    rows = spark.createDataFrame([("a", "r", True, None, None)], TABLES["metrics_validators"].columns)
    t.insert("metrics_validators", rows)
    assert (tmp_path / "metrics_validators" / "created_day=2024-05-01").exists()
    assert t.read("metrics_validators").columns == [*rows.columns, "created_ts"]


def test_folder_upserts_and_purges(spark, tmp_path):
    early = S.TableFolder(spark, str(tmp_path), F.lit(datetime(2024, 5, 1, 12)))
    late = S.TableFolder(spark, str(tmp_path), F.lit(datetime(2024, 5, 1, 13, 30)))
    schema = TABLES["kpi_series"].columns
    day = datetime(2024, 5, 1).date()
    early.upsert("kpi_series", spark.createDataFrame([("a", day, 1.0, [])], schema))
    late.upsert("kpi_series", spark.createDataFrame([("a", day, 2.0, []), ("b", day, 3.0, [])], schema))
    rows = {r.kpi_id: r for r in late.read("kpi_series").collect()}
    assert rows["a"].value == 2.0 and rows["a"].created_ts == datetime(2024, 5, 1, 12)
    late.purge("kpi_series", 60)
    assert [r.kpi_id for r in late.read("kpi_series").collect()] == ["b"]


def test_a_querys_list_is_replaced_and_old_versions_go(spark, tmp_path):
    t = S.TableFolder(spark, str(tmp_path))
    schema = TABLES["precomputed_neighbors"].columns
    for rows in ([("q", "a", "text", 0.9), ("r", "a", "text", 0.8)], [("q", "b", "text", 0.7)], [("q", "c", "text", 0.6)]):
        t.replace("precomputed_neighbors", spark.createDataFrame(rows, schema), ["query_id"])
    assert {(r.query_id, r.neighbor_id) for r in t.read("precomputed_neighbors").collect()} == {("q", "c"), ("r", "a")}
    t.purge("precomputed_neighbors", 60)
    t.purge("precomputed_neighbors", 60)
    assert sorted(p.name for p in (tmp_path / "precomputed_neighbors").iterdir()) == ["v=2", "v=3"]


def test_insert_uses_its_source_once(spark, tmp_path):
    t, asked = S.TableFolder(spark, str(tmp_path)), spark.sparkContext.accumulator(0)
    schema = "object_uri string, media_type string"
    t.insert("objects_pdfs", spark.createDataFrame([("a", "pdf")], schema))

    def model(batches):
        for batch in batches:
            asked.add(batch.num_rows)
            yield batch

    source = spark.createDataFrame([(f"u{i // 2}", "pdf") for i in range(100)], schema).mapInArrow(model, schema)
    t.insert("objects_pdfs", source)
    assert asked.value == 100 and t.read("objects_pdfs").count() == 51


def test_uncommitted_version_is_ignored(spark, tmp_path):
    t = S.TableFolder(spark, str(tmp_path))
    t.upsert("metrics_index_state", spark.createDataFrame([("i", 5)], "index_name string, last_row_count bigint"))
    broken = tmp_path / "metrics_index_state" / "v=2"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"half a file")
    assert t.read("metrics_index_state").first().last_row_count == 5


def test_append_only_tables_refuse_updates(spark, tmp_path):
    t = S.TableFolder(spark, str(tmp_path))
    for call in (lambda: t.upsert("text_chunks", None), lambda: t.purge("text_emb")):
        with pytest.raises(ValueError):
            call()


def test_counts_cover_every_table(spark, tmp_path):
    rows = {r.table_name: r.n for r in S.TableFolder(spark, str(tmp_path)).counts().collect()}
    assert set(rows) == set(TABLES) and set(rows.values()) == {0} and REWRITTEN < set(TABLES)


def test_files_become_chunks_and_only_new_ones_are_opened(spark, tmp_path):
    for name, text in (("a.txt", "Üben"), ("sub/b.txt", "two"), ("c.bin", "other"), ("empty.txt", "")):
        path = tmp_path / "files" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
    listing = list_objects(spark, str(tmp_path / "files"), "*.txt")
    assert "content" not in listing.columns
    assert {r.object_uri.rsplit("/", 1)[1] for r in listing.collect()} == {"a.txt", "b.txt"}
    assert "content" not in listing._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]

    files = list_objects(spark, str(tmp_path / "files"), "*.txt", with_content=True)
    read = lambda df: df.withColumn("text", F.decode("content", "UTF-8"))
    chunks = extract_chunks(files, PDF_SUFFIX, extractor=read)
    assert sorted(r.text for r in chunks.collect()) == ["two", "Üben"]
    done = chunks.filter("text = 'two'").select("chunk_id")
    assert [r.text for r in extract_chunks(files, PDF_SUFFIX, extractor=read, done=done).collect()] == ["Üben"]


def test_rows_whose_keys_do_not_repeat_are_not_moved(spark, tmp_path):
    rows = [(i, None if i == 3 else f"k{i}", "text") for i in range(50)]
    spark.createDataFrame(rows, "n int, k string, text string").write.parquet(f"{tmp_path}/once")
    once = S.without_repeats(spark.read.parquet(f"{tmp_path}/once"), ["k"])
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString() and once.count() == 50
    more = [*rows, (90, None, "a"), (91, "k5", "b"), (92, "k5", "c")]
    spark.createDataFrame(more, "n int, k string, text string").write.parquet(f"{tmp_path}/more")
    stored = spark.read.parquet(f"{tmp_path}/more")
    few, many = S.without_repeats(stored, ["k"]), S.without_repeats(stored, ["k"], broadcast_keys=1)
    assert pairs(few.fillna("-")) == pairs(many.fillna("-")) and few.count() == few.select("k").distinct().count() == 50


def test_an_empty_table_costs_no_join(spark, tmp_path):
    tables = S.TableFolder(spark, str(tmp_path))
    for name in TABLES:
        df = tables.read(name)
        assert df.count() == 0 and df.columns[-1] == "created_ts"
    done = tables.read("text_emb")
    assert done.schema["vector"].dataType.simpleString() == "array<double>"
    todo = spark.range(9).select(F.col("id").cast("string").alias("chunk_id")).join(done.select("chunk_id"), "chunk_id", "left_anti")
    plan = todo._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and todo.count() == 9


def test_an_insert_leaves_no_copy_of_its_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda spark, label: f"{tmp_path}/shared/{label}-{len(made.append(label) or made)}")
    made = []
    tables = S.TableFolder(spark, f"{tmp_path}/tables")
    rows = [("a", "q", [1.0]), ("b", "q", [1.0]), ("b", "q", [1.0])]
    tables.insert("hot_queries", spark.createDataFrame(rows, "query_id string, query_text string, embedding array<double>"))
    assert tables.read("hot_queries").count() == 2 and "insert" in made
    assert not [p for p in (tmp_path / "shared").iterdir() if p.name.startswith("insert")]

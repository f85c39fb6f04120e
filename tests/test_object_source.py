"""Objects as a data source: batch, stream, sink, and chunks of a folder of which only new files are read."""

import time

import pytest
from pyspark.sql import functions as F

from evidex.operators.chunks import SCREEN_SUFFIX, extract_chunks
from evidex.sources import object_source as O
from evidex.sources.writes import TableFolder

PAGE = "<html><script>x</script><p>Hello <b>world</b></p></html>"


@pytest.fixture(scope="module", autouse=True)
def registered_format(spark):
    O.register_objects(spark)


def put(folder, **files):
    for name, body in files.items():
        path = folder / name.replace("__", "/").replace("_dot_", ".")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body if isinstance(body, bytes) else body.encode())


def listed(spark, folder, **options):
    found = spark.read.format("objects").options(**options).load(str(folder)).collect()
    return {r.object_uri[len(str(folder)) + 1 :]: r for r in found}


def test_a_folder_is_listed_by_parts(spark, tmp_path):
    put(tmp_path, a_dot_html=PAGE, x__b_dot_txt="text", x__y__z__c_dot_txt=b"\xff\xfe", other__d_dot_bin=b"", _hidden="no", x___tmp="no")
    rows = listed(spark, tmp_path)
    assert set(rows) == {"a.html", "x/b.txt", "x/y/z/c.txt", "other/d.bin"}
    assert rows["a.html"].media_type == "text/html" and rows["x/b.txt"].length == 4 and all(r.content is None for r in rows.values())
    read = listed(spark, tmp_path, content="true", pattern="*.txt", splits="3")
    assert {k: bytes(r.content) for k, r in read.items()} == {"x/b.txt": b"text", "x/y/z/c.txt": b"\xff\xfe"}
    df = spark.read.format("objects").option("content", "true").load(str(tmp_path))
    assert df.rdd.getNumPartitions() == 3 * O.SPLITS
    assert listed(spark, tmp_path / "nothing") == {}


def test_rows_are_written_as_objects(spark, tmp_path):
    rows = [("a/1.txt", b"one"), ("a/2.txt", None), ("b.txt", b"\x00\xff"), (None, b"no name")] + [(f"many/{i}.txt", str(i).encode()) for i in range(50)]
    df = spark.createDataFrame(rows, O.OBJECT_INPUT).repartition(4)
    df.write.format("objects").mode("append").save(str(tmp_path / "out"))
    read = {k: bytes(r.content) for k, r in listed(spark, tmp_path / "out", content="true").items()}
    assert read == {n: b or b"" for n, b in rows if n}
    assert not [p for p in (tmp_path / "out").rglob("_*")]


def test_a_failed_write_leaves_no_object(spark, tmp_path):
    bad = spark.range(20).select(F.concat(F.col("id").cast("string"), F.lit(".txt")).alias("name"), F.expr("if(id = 19, raise_error('stop'), cast('x' as binary))").alias("content"))
    with pytest.raises(Exception, match="stop"):
        bad.repartition(2).write.format("objects").mode("append").save(str(tmp_path / "out"))
    assert listed(spark, tmp_path / "out") == {}


def test_registered_uris_join_the_listing_once(spark, tmp_path):
    put(tmp_path, in__a_dot_html=PAGE, in__b_dot_txt="plain", in__c_dot_jpg=b"\xff\xd8", far__d_dot_txt="far away")
    rows = [(str(tmp_path / "far/d.txt"), "text/plain"), (str(tmp_path / "in/a.html"), "text/html"), (str(tmp_path / "gone.txt"), "text/plain"), (None, "text/plain")]
    registered = spark.createDataFrame(rows + rows[:1], "object_uri string, media_type string")
    found = O.all_objects(spark, str(tmp_path / "in"), registered).collect()
    assert sorted(r.object_uri.rsplit("/", 1)[1] for r in found) == ["a.html", "b.txt", "c.jpg", "d.txt", "gone.txt"]
    fetched = {r.object_uri.rsplit("/", 1)[1]: r for r in O.fetch_contents(O.all_objects(spark, str(tmp_path / "in"), registered)).collect()}
    assert bytes(fetched["d.txt"].content) == b"far away" and fetched["gone.txt"].content is None and "FileNotFound" in fetched["gone.txt"].error
    chunks = O.folder_chunks(spark, str(tmp_path / "in"), registered)(spark.createDataFrame([], "chunk_id string"))
    assert {r.source_uri.rsplit("/", 1)[1]: r.text for r in chunks.collect()} == {"a.html": "Hello world", "b.txt": "plain", "d.txt": "far away"}


def test_a_second_run_reads_only_new_files(spark, tmp_path):
    put(tmp_path, in__a_dot_txt="first", in__b_dot_txt="second")
    tables = TableFolder(spark, str(tmp_path / "tables"))
    make = O.folder_chunks(spark, str(tmp_path / "in"))
    tables.insert("text_chunks", make(tables.read("text_chunks")))
    # What is stored is not read again: the old files could even be gone from the store's content.
    put(tmp_path, in__a_dot_txt="changed", in__c_dot_txt="third")
    tables.insert("text_chunks", make(tables.read("text_chunks")))
    assert sorted(r.text for r in tables.read("text_chunks").collect()) == ["first", "second", "third"]


def test_a_stream_takes_each_file_once(spark, tmp_path):
    put(tmp_path, in__a_dot_txt="first", in__x__b_dot_txt="second")
    tables, counts = TableFolder(spark, str(tmp_path / "tables")), []

    def run():
        stream = spark.readStream.format("objects").options(content="true", settleSeconds="0").load(str(tmp_path / "in"))
        seen = []

        def keep(batch, _):
            seen.append(batch.count())
            tables.insert("text_chunks", extract_chunks(batch, SCREEN_SUFFIX, text=O.object_text()))

        query = stream.writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
        counts.append(sum(seen))

    run()
    time.sleep(0.1)
    put(tmp_path, in__x__c_dot_txt="third")
    time.sleep(0.1)
    run()
    assert counts == [2, 1]
    assert sorted(r.text for r in tables.read("text_chunks").collect()) == ["first", "second", "third"]

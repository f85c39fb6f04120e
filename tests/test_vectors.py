import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from evidex.operators import embed, ivf, vectors
from evidex.operators.vectors import mean_vectors, vector_topk
from evidex.plans import registered
from evidex.session import ARROW_BATCH_BYTES

SCHEMA = "item_id bigint, vector array<double>, kind string"


def brute(base, queries, k):
    out = []
    for q, qv in queries:
        if not qv or not any(qv):
            continue
        scored = []
        for i, v in base:
            if v and any(v):
                a, b = np.array(v), np.array(qv)
                scored.append((round(1 - float(a @ b) / float(np.linalg.norm(a) * np.linalg.norm(b)), 9), i))
        for rank, (d, i) in enumerate(sorted(scored)[:k], 1):
            out.append((q, i, rank, d))
    return sorted(out)


def got(df):
    return sorted((r.query_id, r.item_id, r["rank"], r.distance) for r in df.collect())


def close(a, b):
    return [x[:3] for x in a] == [x[:3] for x in b] and np.allclose([x[3] for x in a], [x[3] for x in b], atol=2e-9)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(7)
    base = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    # A third of all rows are copies of one vector.
    base += [(1000 + i, base[0][1]) for i in range(150)]
    base += [(2000, None), (2001, []), (2002, [0.0] * 8)]
    queries = [(f"q{i}", rng.normal(size=8).tolist()) for i in range(23)]
    queries += [("copy", base[0][1]), ("zero", [0.0] * 8), ("none", None)]
    return base, queries


@pytest.fixture(scope="module")
def frames(spark, rows):
    base, queries = rows
    b = spark.createDataFrame([(i, v, "a" if i % 2 else "b") for i, v in base], SCHEMA).repartition(5)
    q = spark.createDataFrame(queries, "query_id string, vector array<double>")
    return b, q


@pytest.mark.parametrize("k", [1, 7, 40, 1000])
def test_equals_brute_force(frames, rows, k):
    assert close(got(vector_topk(*frames, k=k)), brute(*rows, k))


def test_many_queries_meet_in_blocks(frames, rows):
    found = vector_topk(*frames, k=9, max_broadcast=3, block_base_rows=64, block_query_rows=5)
    assert close(got(found), brute(*rows, 9))
    plan = found._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_ties_are_ordered_by_id(frames):
    hits = [r for r in got(vector_topk(*frames, k=12)) if r[0] == "copy"]
    assert [r[1] for r in hits] == [0] + list(range(1000, 1011))


def test_constraints_come_after_the_cut_and_prefilter_before(frames, rows):
    base, queries = rows
    after = got(vector_topk(*frames, k=10, constraints=[("kind", "=", "a")]))
    assert after == [r for r in got(vector_topk(*frames, k=10)) if r[1] % 2]
    before = got(vector_topk(*frames, k=10, prefilter=[("kind", "=", "a")]))
    assert close(before, brute([b for b in base if b[0] % 2], queries, 10))


def test_unknown_operator_is_refused(frames):
    with pytest.raises(ValueError):
        vector_topk(*frames, k=1, constraints=[("kind", "; drop", "a")])


def test_no_usable_query(spark, frames):
    q = spark.createDataFrame([("x", None)], "query_id string, vector array<double>")
    assert vector_topk(frames[0], q, k=3).count() == 0


def test_string_ids(spark, frames):
    b = frames[0].withColumn("item_id", F.format_string("i%05d", "item_id"))
    ids = [r.item_id for r in vector_topk(b, frames[1].filter("query_id = 'copy'"), k=3).orderBy("rank").collect()]
    assert ids == ["i00000", "i01000", "i01001"]


def test_mean_vectors(spark):
    df = spark.createDataFrame([("a", [1.0, 3.0]), ("a", [3.0, 5.0]), ("b", [2.0, 2.0]), ("b", None)], "k string, v array<double>")
    assert {r.k: list(r.vector) for r in mean_vectors(df, "k", "v").collect()} == {"a": [2.0, 4.0], "b": [2.0, 2.0]}


@pytest.fixture(scope="module")
def cells(frames):
    centers = ivf.train_cells(frames[0], 6)
    return centers, ivf.assign_cells(frames[0], centers)


def test_all_cells_probed_is_exact(frames, rows, cells):
    centers, based = cells
    assert based.count() == 450
    found = ivf.ivf_topk(based, frames[1], centers, k=11, nprobe=len(centers))
    assert close(got(found), brute(*rows, 11))


@pytest.mark.parametrize("limits", [{}, {"max_broadcast": 3, "block_base_rows": 50, "block_query_rows": 4}])
def test_some_cells_probed(frames, rows, cells, limits):
    centers, based = cells
    probes = ivf.nearest_cells(frames[1], centers, 2, "query_id").collect()
    cell_of = {r.item_id: r.cell for r in based.collect()}
    base, queries = rows
    wanted = []
    for q in queries:
        own = {p.cell for p in probes if p.query_id == q[0]}
        wanted += brute([b for b in base if cell_of.get(b[0]) in own], [q], 5)
    assert close(got(ivf.ivf_topk(based, frames[1], centers, k=5, nprobe=2, **limits)), sorted(wanted))


def test_recall_grows_with_the_cells_read(frames, cells):
    centers, based = cells
    exact = vector_topk(*frames, k=10)
    recall = [
        ivf.recall_against(ivf.ivf_topk(based, frames[1], centers, 10, n), exact).agg(F.avg("recall")).first()[0]
        for n in (1, 3, 6)
    ]
    assert recall == sorted(recall) and recall[-1] == 1.0


def test_written_cells_are_pruned(spark, tmp_path, frames, rows, cells):
    centers, based = cells
    path = str(tmp_path / "cells")
    ivf.write_cells(based.select("item_id", "vector", "cell"), path, rows_per_file=40)
    back = spark.read.parquet(path)
    assert back.count() == 450
    assert close(got(ivf.ivf_topk(back, frames[1], centers, 11, len(centers))), brute(*rows, 11))
    one = ivf.ivf_topk(back, frames[1].filter("query_id = 'q1'"), centers, 5, 1)
    plan = one._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "cell" in plan.split("PartitionFilters")[1][:200]


def test_index_decisions(spark):
    counts = spark.createDataFrame(
        [("new", 5), ("empty", 0), ("edge", 115), ("over", 1151), ("from_zero", 1), ("same", 7)],
        "index_name string, row_count bigint",
    )
    state = spark.createDataFrame(
        [("edge", 100), ("over", 1000), ("from_zero", 0), ("same", 7)], "index_name string, last_row_count bigint"
    )
    made = ivf.index_decision(counts, state)
    assert {r.index_name: r.decision for r in made.collect()} == {
        "new": "CREATE", "empty": "SKIP", "edge": "KEEP", "over": "REBUILD", "from_zero": "REBUILD", "same": "KEEP",
    }
    # The stored count only moves with a build, so that slow growth adds up.
    assert {r.index_name: r.last_row_count for r in ivf.index_state(made).collect()} == {
        "new": 5, "edge": 100, "over": 1151, "from_zero": 1, "same": 7,
    }


def test_more_means_than_cells_are_an_error(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(registered, "MEAN_CELLS", 9)
    with pytest.raises(ValueError, match="more than 9"):
        registered.ivf_topk(spark, sf_dir)


def batch_bytes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])


def test_batches_of_wide_vectors_are_bounded_by_bytes(spark):
    """By rows alone, 4,000 vectors of 768 numbers came to a worker as one batch of 24 MB."""
    texts = spark.range(0, 4000, 1, 1).selectExpr("id as key", "concat('word', id, ' ', id % 7) as text")
    made = embed.hashed_embedding(texts, "key", "text")
    sizes = [r.n for r in made.mapInArrow(batch_bytes, "n long").collect()]
    assert sum(sizes) >= 4000 * 768 * 8 and max(sizes) <= ARROW_BATCH_BYTES + 2 * 768 * 8


def test_workers_hold_few_numbers_at_once():
    lengths = np.array([3, 900_000, 0, 5, 400_000, 200_000, *[1] * 2000])
    cuts = list(embed._steps(lengths, 768))
    assert [a for a, _ in cuts] == [0, *[b for _, b in cuts[:-1]]] and cuts[-1][1] == len(lengths)
    for a, b in cuts:
        assert b - a == 1 or (lengths[a:b].sum() <= embed.NUMBERS_PER_STEP and (b - a) * 768 <= embed.NUMBERS_PER_STEP)
    assert list(embed._steps(np.array([], dtype=int), 768)) == []
    batch = pa.RecordBatch.from_arrays([pa.array(range(3000)), pa.array([[1.0] * 768] * 3000)], names=["item_id", "vector"])
    parts = list(vectors._steps([batch, batch.slice(0, 0)]))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(3000))
    assert max(p.num_rows for p in parts) * 768 <= vectors.NUMBERS_PER_STEP


def test_search_in_steps_is_exact(spark):
    rng = np.random.default_rng(3)
    many = [(i, rng.integers(-3, 4, size=64).astype(float).tolist()) for i in range(9000)]
    base = spark.createDataFrame(many, "item_id bigint, vector array<double>").coalesce(1)
    asked = [(f"q{i}", many[i][1]) for i in range(4)]
    queries = spark.createDataFrame(asked, "query_id string, vector array<double>")
    assert close(got(vector_topk(base, queries, 9)), brute(many, asked, 9))

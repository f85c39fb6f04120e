"""Exact search over cells: the same rows as without cells, from fewer of them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from evidex.operators import bounds as B
from evidex.operators import ivf
from evidex.operators.vectors import vector_topk
from evidex.plans import registered as R

TESTDATA = "/root/testdata"


def clustered(n_centers=12, per=30, dim=8, spread=0.15, seed=1):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(n_centers, dim))
    return np.concatenate([m + spread * rng.normal(size=(per, dim)) for m in middles])


def in_cells(spark, vectors, n_cells, pivots=64):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    # Copies that tie, and rows that take no part.
    rows += [(1000 + i, rows[0][1]) for i in range(50)] + [(2000, None), (2001, []), (2002, [0.0] * len(rows[0][1]))]
    base = spark.createDataFrame(rows, "item_id long, vector array<double>").repartition(4)
    centers = ivf.train_cells(base, n_cells)
    cells = ivf.assign_cells(base, centers)
    return base, cells, B.cell_bounds(B.cell_angles(cells, centers, pivots=pivots), centers)


def some_queries(spark, vectors, n=15):
    rng = np.random.default_rng(3)
    rows = [(f"q{i}", [float(x) for x in vectors[i * 7] + 0.1 * rng.normal(size=vectors.shape[1])]) for i in range(n)]
    rows += [("far", [1.0] + [0.0] * (vectors.shape[1] - 1)), ("none", None), ("zero", [0.0] * vectors.shape[1])]
    return spark.createDataFrame(rows, "query_id string, vector array<double>")


def same(a, b):
    columns = ["query_id", "item_id", "distance", "rank"]
    return sorted(map(tuple, a.select(columns).collect())) == sorted(map(tuple, b.select(columns).collect()))


@pytest.mark.parametrize("pivots", [1, 64])
@pytest.mark.parametrize("max_broadcast", [4096, 3])
def test_equals_exact_search(spark, pivots, max_broadcast):
    vectors = clustered()
    base, cells, bounds = in_cells(spark, vectors, 12, pivots)
    queries = some_queries(spark, vectors)
    for k in (1, 10, 60):
        hits, cost = B.bounded_topk(cells, queries, bounds, k, max_broadcast=max_broadcast)
        assert same(hits, vector_topk(base, queries, k))
    used = cost.agg(F.sum("rows_read"), F.count("*")).first()
    assert used[1] == 16 and used[0] < 0.8 * 16 * bounds.rows.sum()


def test_more_rows_wanted_than_there_are(spark):
    vectors = clustered(3, 4)
    base, cells, bounds = in_cells(spark, vectors, 3)
    queries = some_queries(spark, vectors, 1)
    for max_broadcast in (4096, 1):
        hits, cost = B.bounded_topk(cells, queries, bounds, 100, max_broadcast=max_broadcast)
        assert same(hits, vector_topk(base, queries, 100))
        assert {r.cells_read for r in cost.collect()} == {len(bounds.cells)}


def test_no_queries_and_repeated_queries(spark):
    vectors = clustered(3, 4)
    _, cells, bounds = in_cells(spark, vectors, 3)
    queries = some_queries(spark, vectors, 2)
    hits, cost = B.bounded_topk(cells, queries.limit(0), bounds, 5)
    assert hits.count() == cost.count() == 0 and hits.columns == ["query_id", "item_id", "distance", "rank"]
    with pytest.raises(ValueError, match="twice"):
        B.bounded_topk(cells, queries.union(queries), bounds, 5)


def test_bounds_hold_for_every_row(spark):
    vectors = clustered(spread=0.5)
    _, cells, bounds = in_cells(spark, vectors, 7)
    rows = cells.select("cell", "vector").collect()
    x = np.array([r.vector for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q = np.random.default_rng(9).normal(size=(40, x.shape[1]))
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    lower = bounds.distances(q)
    at = {int(c): n for n, c in enumerate(bounds.cells)}
    distance = 1 - q @ x.T
    assert all((lower[:, at[r.cell]] <= distance[:, i] + B.MARGIN).all() for i, r in enumerate(rows))
    assert bounds.rows.sum() == len(rows)


def test_a_round_opens_only_the_folders_it_needs(spark, tmp_path):
    vectors = clustered(spread=0.05)
    base, cells, bounds = in_cells(spark, vectors, 12)
    ivf.write_cells(cells, str(tmp_path / "cells"))
    kept = spark.read.parquet(str(tmp_path / "cells"))
    queries = some_queries(spark, vectors, 1).filter("query_id = 'q0'")
    hits, cost = B.bounded_topk(kept, queries, bounds, 5)
    assert same(hits, vector_topk(base, queries, 5)) and cost.first().cells_read < 6


def test_less_than_half_of_the_rows_are_read(spark):
    sf = f"{TESTDATA}/sf0.1"
    cells, queries, stored_bounds = R._stored_cells(spark, sf)
    hits, cost = B.bounded_topk(cells, queries, stored_bounds, **R.EMBEDDINGS)
    n = stored_bounds.rows.sum()
    assert cost.agg(F.avg("rows_read")).first()[0] < 0.5 * n
    assert same(hits, R.vector_topk_query(spark, sf))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_probes_find_nine_of_ten(spark, sf):
    recall = [r.recall for r in R.ivf_recall(spark, f"{TESTDATA}/{sf}").collect()]
    assert np.mean(recall) >= 0.9 and min(recall) >= 0.8

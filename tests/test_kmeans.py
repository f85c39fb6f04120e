"""Training of cells."""

import numpy as np
import pytest

from evidex.operators import ivf, kmeans


def frame(spark, vectors, parts=3):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "item_id bigint, vector array<double>").repartition(parts)


def unit(rows):
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def test_as_many_cells_as_asked_where_most_rows_lie_close(spark):
    rng = np.random.default_rng(3)
    far, bunch = np.eye(24)[:12], np.eye(24)[20] + 1e-3 * rng.standard_normal((60, 24))
    centers = ivf.train_cells(frame(spark, np.concatenate([far, bunch])), 40)
    assert centers.shape == (40, 24) and np.allclose(np.linalg.norm(centers, axis=1), 1.0)
    assert np.allclose((far @ centers.T).max(axis=1), 1.0)


def test_training_depends_on_the_rows_and_not_on_where_they_stand(spark):
    rng = np.random.default_rng(5)
    middles = unit(rng.standard_normal((9, 16)))
    vectors = np.repeat(middles, 40, axis=0) + 0.05 * rng.standard_normal((360, 16))
    made = [ivf.train_cells(frame(spark, vectors, parts), 9) for parts in (1, 7)]
    assert np.array_equal(*made)
    assert (middles @ made[0].T).max(axis=1).min() > 0.99


def test_copies_take_one_cell(spark):
    rng = np.random.default_rng(7)
    others = unit(rng.standard_normal((5, 8)))
    vectors = np.concatenate([np.repeat([[3.0] + [0.0] * 7], 200, axis=0), others, np.zeros((2, 8))])
    centers = ivf.train_cells(frame(spark, vectors), 8)
    assert len(centers) == 6
    assert np.allclose((unit(vectors[:205]) @ centers.T).max(axis=1), 1.0)


def test_a_round_moves_centres_to_the_means_of_their_cells(spark, monkeypatch):
    rng = np.random.default_rng(11)
    vectors = unit(np.abs(rng.standard_normal((300, 12))))
    df = frame(spark, vectors, 5).withColumnRenamed("item_id", "draw")
    training, centers = kmeans.Training(kmeans.packed(df, 12), 12), vectors[:10].copy()
    monkeypatch.setattr(kmeans, "SCORES_PER_STEP", 70)
    cells = np.argmax(vectors @ centers.T, axis=1)
    wanted = unit(np.stack([vectors[cells == c].sum(axis=0) for c in range(10)]))
    assert np.allclose(training.means(centers), wanted, atol=1e-6)
    assert (training.weights(centers) == np.bincount(cells, minlength=10)).all()
    cost = {r.draw: r.cost for r in training.costs(centers).collect()}
    assert np.allclose([cost[i] for i in range(300)], 1.0 - (vectors @ centers.T).max(axis=1), atol=1e-6)


def test_vectors_of_different_length_are_an_error(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [0.0, 1.0])], "item_id bigint, vector array<double>")
    with pytest.raises(Exception, match="different length"):
        ivf.train_cells(df, 2)


@pytest.mark.parametrize("scores", [ivf.SCORES_PER_STEP, 40])
def test_cells_in_single_precision_are_those_of_rounded_distances(monkeypatch, scores):
    rng = np.random.default_rng(13)
    monkeypatch.setattr(ivf, "SCORES_PER_STEP", scores)
    centers = unit(np.abs(rng.standard_normal((30, 48))))
    # Copies of a centre, centres a hair apart, and rows half-way between two: the first of equal distances is taken.
    centers[7], centers[9] = centers[3], unit(centers[[4]] + 1e-8 * rng.standard_normal((1, 48)))[0]
    vectors = unit(np.concatenate([np.abs(rng.standard_normal((500, 48))), centers, centers[:10] + centers[10:20]]))
    wanted = np.argmin(np.round(1.0 - np.einsum("nd,kd->nk", vectors, centers), 9), axis=1)
    assert (ivf.nearest_rounded(vectors, centers) == wanted).all()
    assert (ivf.nearest_rounded(vectors, np.repeat(centers[:1], 30, axis=0)) == 0).all()


def test_cells_are_found_once_when_they_are_written(spark, tmp_path):
    asked = spark.sparkContext.accumulator(0)
    centers = unit(np.random.default_rng(17).standard_normal((3, 6)))

    def counting(batches):
        for batch in batches:
            asked.add(batch.num_rows)
            yield batch

    df = frame(spark, np.random.default_rng(19).standard_normal((50, 6)))
    ivf.write_cells(ivf.assign_cells(df.mapInArrow(counting, df.schema), centers), f"{tmp_path}/cells")
    assert asked.value == 50 and spark.read.parquet(f"{tmp_path}/cells").count() == 50

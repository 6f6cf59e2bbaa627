"""Whitening against a dense eigendecomposition."""

import numpy as np
import pytest

from pricelane.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n int, vector string, component string"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, 1, "x", "y") for i, v in zip(ids, vectors)], SCHEMA)


def taken(vectors):
    return np.array([np.floor(64 * np.float32(v).astype(float)) + 1000000 for v in vectors])


def compare(spark, tmp_path, vectors, expected, k=32):
    frame(spark, vectors).write.parquet(f"{tmp_path}/embeddings.parquet")
    rows = whitening.op11_whitening(spark, str(tmp_path)).collect()
    x = taken(expected)
    n = len(x)
    apart = x - x.mean(axis=0)
    values, turn = np.linalg.eigh(apart.T @ apart / n)
    values, turn = values[::-1], turn[:, ::-1]
    rank = int((values[:k] > 1e-9 * values[0]).sum())
    assert len(rows) == n * min(k, rank)
    got = np.zeros((n, min(k, rank)))
    ids = sorted({r["vec_id"] for r in rows})
    for r in rows:
        got[ids.index(r["vec_id"]), r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-9)
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, x.sum(axis=0))) for row in x]
    assert {(ids.index(r["vec_id"]), r["deviation"]) for r in rows} == set(enumerate(exact))
    return got, apart @ turn[:, : got.shape[1]] / np.sqrt(values[: got.shape[1]])


def test_many_dimensions_against_dense(spark, tmp_path):
    rng = np.random.default_rng(1)
    vectors = (rng.standard_normal((700, 90)) * np.linspace(1, 0.2, 90)).tolist()
    got, want = compare(spark, tmp_path, vectors, vectors)
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got * signs - want).max() < 1e-8


def test_fewer_dimensions_and_odd_vectors(spark, tmp_path):
    rng = np.random.default_rng(2)
    good = (rng.standard_normal((50, 6)) * [1, 2, 3, 4, 5, 6]).tolist()
    odd = [None, [], [1.0] * 5 + [None], [1.0] * 5 + [float("nan")], [1.0] * 5 + [float("inf")], [1.0] * 7]
    got, want = compare(spark, tmp_path, good + odd, good)
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got * signs - want).max() < 1e-9


def test_missing_rank(spark, tmp_path):
    rng = np.random.default_rng(3)
    vectors = np.repeat(np.round(rng.standard_normal((40, 3)) * 64) / 64, 20, axis=1).tolist()
    got, _ = compare(spark, tmp_path, vectors, vectors)
    assert got.shape[1] == 3


def test_equal_eigenvalues_span_the_same_space(spark):
    corners = [[float(s) if i == j else 0.0 for j in range(8)] for i in range(8) for s in (1, -1)]
    model = whitening.fit_whitening(frame(spark, corners))
    assert np.allclose(model.eigenvalues, model.eigenvalues[0]) and len(model.eigenvalues) == 8
    assert np.abs(model.components.T @ model.components - np.eye(8)).max() < 1e-12


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 3, [[0.0, 0.0], None]])
def test_nothing_to_whiten(spark, tmp_path, vectors):
    frame(spark, vectors).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert whitening.op11_whitening(spark, str(tmp_path)).collect() == []


def test_repeated_rows_and_null_keys_come_out(spark, tmp_path):
    frame(spark, [[1.0, 0.0], [0.0, 1.0], [0.0, 1.0], [3.0, 1.0]], [1, 2, 2, None]).write.parquet(f"{tmp_path}/embeddings.parquet")
    rows = whitening.op11_whitening(spark, str(tmp_path)).collect()
    assert sorted((r["vec_id"] or 0) for r in rows) == [0, 0, 1, 1, 2, 2, 2, 2]


def test_a_hidden_direction_is_found(spark):
    """A start without any part in the greatest direction: the probe must bring it in."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((300, 80))
    x[:, 0] *= 50
    blocks = whitening.read_blocks(frame(spark, x.tolist()), "vec_id", "embedding", 64, 0)
    covariance = whitening.Covariance(blocks)
    values, vectors = np.linalg.eigh(np.cov(np.floor(64 * np.float32(x).astype(float)).T, bias=True))
    found = vectors[:, ::-1][:, 1:33]
    extra = whitening.greater_outside(covariance, found, values[-33], values[-1], np.random.default_rng(5))
    assert extra is not None and abs(extra.T @ vectors[:, -1]).max() > 0.99


def test_tasks_and_driver_add_in_two_steps(spark, monkeypatch):
    monkeypatch.setattr(whitening, "DIRECT_SUMS", 1)
    rng = np.random.default_rng(6)
    x = rng.standard_normal((400, 10))
    model = whitening.fit_whitening(frame(spark, x.tolist()).repartition(7))
    assert model.sums.tolist() == (np.floor(64 * np.float32(x).astype(float)) + 1000000).sum(axis=0).astype(int).tolist()


def test_deviation_beyond_64_bits_is_null(spark):
    model = whitening.Whitening(10**9, np.zeros(2, np.int64), np.eye(2), np.ones(2), 1.0, 0.0, 0)
    assert whitening.deviations(np.array([[10, 0], [0, 1]], np.int64), model) == [None, 10**18]

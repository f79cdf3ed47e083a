"""Whitening against NumPy's eigenvectors and sums in Python integers."""

import math

import numpy as np
import pytest

from dealglass.llm import queries, whitening
from dealglass.llm.common import read

SCHEMA = "vec_id long, embedding array<float>, fixed string, WHITENING string, i int"


def frame(spark, vectors, ids=None):
    rows = [(k, v, "f", "w", 1) for k, v in zip(ids or range(len(vectors)), vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def brute(vectors, count=8):
    """x, exact deviations, eigenvalues and vectors of the covariance, by other means."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(row, sums)] for row in x])
    values, columns = np.linalg.eigh(centred.T @ centred / n)
    return deviations, centred, values[::-1][:count], columns[:, ::-1][:, :count]


def agree(white, fitted, vectors):
    deviations, centred, values, columns = brute(vectors, len(fitted.eigenvalues))
    got = {r["vec_id"]: r["whitening"] for r in white.collect()}
    assert [int(got[k].deviation) for k in range(len(vectors))] == deviations
    whitened = np.array([got[k].whitened for k in range(len(vectors))])
    want = centred @ columns / np.sqrt(values)
    signs = np.sign((whitened * want).sum(0))
    assert np.allclose(whitened, want * signs, rtol=0, atol=1e-9)
    assert np.allclose(fitted.eigenvalues, values, rtol=1e-12)


@pytest.mark.parametrize("size", [1, 2, 3, 9, 40])
def test_eigenpairs(size):
    random = np.random.default_rng(size)
    some = random.standard_normal((size, size + 3))
    matrix = some @ some.T
    values, vectors = whitening.leading_eigenpairs(matrix, 8)
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:8], rtol=1e-13)
    assert np.allclose(matrix @ vectors.T, vectors.T * values, atol=1e-11)
    assert np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-14)


@pytest.mark.parametrize("values", [
    [5, 5, 5, 2, 1, 0], [5, 5 - 1e-12, 5 - 2e-9, 5 - 1e-5, 1, 1], [0, 0, 0, 0, 0, 0],
    [7, 7, 7, 7, 7, 7], [1e-30, 1e-31, 0, 0, 0, 0]])
def test_clusters_stay_orthogonal(values):
    turn, _ = np.linalg.qr(np.random.default_rng(5).standard_normal((6, 6)))
    matrix = (turn * np.array(values)) @ turn.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.leading_eigenpairs(matrix, 5)
    norm = max(np.abs(matrix).max(), 1e-300)
    assert np.allclose(found / norm, np.array(values[:5]) / norm, atol=1e-14)
    assert np.allclose(matrix @ vectors.T / norm, vectors.T * found / norm, atol=1e-13)
    assert np.allclose(vectors @ vectors.T, np.eye(5), atol=1e-13)


def test_sturm_counts():
    diagonal, off = np.array([2.0, 0.0, 2.0, 1.0]), np.array([1.0, 0.0, 0.5])
    matrix = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    values = np.linalg.eigvalsh(matrix)
    for at in (-3.0, 0.3, 1.0, 1.6, 2.2, 9.0):
        assert whitening.sturm_counts(diagonal, off, np.array([at]))[0] == (values < at).sum()


def test_rows_and_repeats(spark):
    random = np.random.default_rng(3)
    vectors = random.normal(0, 0.3, (40, 12)).astype(np.float32).tolist() + [[0.25] * 12] * 20
    white, fitted, error = whitening.whiten(frame(spark, vectors))
    agree(white, fitted, vectors)
    assert fitted.n == 60 and len(fitted.eigenvalues) == 8 and 0 <= error < 1e-12
    assert sorted(white.columns) == ["embedding", "fixed", "i", "vec_id", "whitening"]


def test_large_entries_are_exact(spark):
    vectors = [[1e9, -3.0], [-2e9, 5.0], [7e8, 1.5], [123456.0, 0.25]]
    white, fitted, _ = whitening.whiten(frame(spark, vectors))
    agree(white, fitted, vectors)


def test_odd_vectors_are_left_out(spark):
    fine = [[0.1, 0.2], [0.3, -0.4], [0.5, 0.5]]
    odd = [None, [], [None, 1.0], [float("nan"), 1.0], [1.0, float("-inf")], [1.0, 2.0, 3.0],
           [3e38, 1.0]]
    white, fitted, _ = whitening.whiten(frame(spark, fine + odd))
    assert {r["vec_id"] for r in white.collect()} == {0, 1, 2} and fitted.n == 3
    agree(white, fitted, fine)


def test_a_null_id_is_a_row(spark):
    white, fitted, _ = whitening.whiten(frame(spark, [[1.0, 0.0], [0.0, 1.0]], [None, 4]))
    assert {r["vec_id"] for r in white.collect()} == {None, 4} and fitted.n == 2


@pytest.mark.parametrize("vectors", [[], [None, [float("nan")]]])
def test_nothing_to_fit(spark, vectors):
    white, fitted, error = whitening.whiten(frame(spark, vectors))
    assert white.collect() == [] and fitted is None and error == 0


def test_no_variance_no_component(spark):
    white, fitted, error = whitening.whiten(frame(spark, [[1.0, 2.0]] * 5))
    assert [len(r["whitening"].whitened) for r in white.collect()] == [0] * 5
    assert len(fitted.eigenvalues) == 0 and error == 0
    flat, fitted, _ = whitening.whiten(frame(spark, [[1.0, 2.0, 0.0], [2.0, 2.0, 0.0]]))
    assert len(fitted.eigenvalues) == 1


def test_query_over_the_table(spark, folder):
    rows = queries.op12_embedding_whitening(spark, folder).collect()
    source = read(spark, folder, "embeddings").orderBy("vec_id").collect()
    vectors = [r["embedding"] for r in source]
    deviations, centred, values, columns = brute(vectors)
    assert len(rows) == 8 * len(source)
    white = np.zeros((len(source), 8))
    place = {r["vec_id"]: k for k, r in enumerate(source)}
    for r in rows:
        at = place[r["vec_id"]]
        white[at, r["component"] - 1] = r["whitened"]
        assert r["n"] == len(source) and r["deviation"] == deviations[at]
        share = values[r["component"] - 1] / np.trace(centred.T @ centred / len(source))
        assert r["explained"] == pytest.approx(share, rel=1e-10)
        assert 0 <= r["identity_error"] < 1e-10
    covariance = white.T @ white / len(source) - np.outer(white.mean(0), white.mean(0))
    assert np.abs(covariance - np.eye(8)).max() < 1e-10
    want = centred @ columns / np.sqrt(values)
    assert np.allclose(white, want * np.sign((white * want).sum(0)), atol=1e-7)

"""Whitening against numpy's eigenvectors and exact integers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from orderlayers.llm.queries import op12_whitening
from orderlayers.llm.whitening import count_above, largest_components, whiten_embeddings

SMALL = "/root/testdata/sf0.001"


def _matrix(values):
    q, _ = np.linalg.qr(np.random.default_rng(3).standard_normal((len(values), len(values))))
    m = q @ np.diag(values) @ q.T
    return (m + m.T) / 2


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 3, 40),
        np.array([5.0] * 20 + [1.0] * 20),
        np.full(24, 3.0),
        np.concatenate([1 + np.arange(12) * 1e-9, 0.5 + np.arange(12) * 1e-3]),
        10.0 ** -np.arange(8),
        np.array([2.0]),
    ],
)
def test_components_equal_those_of_numpy(values):
    matrix = _matrix(values)
    found, vectors = largest_components(matrix, 16)
    expected = np.sort(np.linalg.eigvalsh(matrix))[::-1][:16]
    assert len(found) == min(16, len(values))
    assert np.abs(found - expected).max() < 1e-11 * expected[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-11 * expected[0]


def test_inertia_counts():
    matrix = _matrix(np.array([4.0, 3.0, 3.0, 1.0, 0.0]))
    assert [count_above(matrix, s) for s in (-1, 0.5, 2, 3.5, 5)] == [5, 4, 3, 1, 0]
    assert count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
    assert len(largest_components(np.zeros((4, 4)), 16)[0]) == 0


def _expected(rows):
    x = {k: [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for k, v in rows}
    fit = np.array(sorted({tuple(v) for v in x.values()}), object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (fit * n - sums).astype(np.float64) / n
    covariance = centred.T @ centred / n
    deviation = {k: int(sum((n * a - s) ** 2 for a, s in zip(v, sums))) for k, v in x.items()}
    return x, n, sums, covariance, deviation


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    x, n, sums, covariance, deviation = _expected([(r[0], r[1]) for r in rows])
    values = np.linalg.eigvalsh(covariance)[::-1][:16]
    found = op12_whitening(spark, SMALL).collect()
    assert len(found) == 16 * len(rows)
    assert {r["n"] for r in found} == {n}
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-10
    assert all(r["deviation"] == deviation[r["vec_id"]] for r in found)
    for r in found:
        assert abs(r["explained"] / (values[r["component"] - 1] / np.trace(covariance)) - 1) < 1e-10
    # Up to sign, each column is the projection on its eigenvector.
    _, vectors = np.linalg.eigh(covariance)
    table = np.zeros((len(rows), 16))
    place = {r[0]: k for k, r in enumerate(rows)}
    for r in found:
        table[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
    own = np.array([(np.array(x[r[0]], object) * n - sums).astype(np.float64) / n for r in rows])
    own = own @ vectors[:, ::-1][:, :16] / np.sqrt(values)
    assert np.abs(np.abs(table) - np.abs(own)).max() < 1e-8


def test_odd_rows(spark):
    schema = "vec_id long, embedding array<float>, label int, x string, n int, component string"
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 2.0], [2.0, 1.0], [2.0, 1.0], [0.5, -3.0], None, [], [nan, 1.0], [1.0, inf], [1.0, None], [1.0, 2.0, 3.0]]
    ids = [1, 2, 2, None, 5, 6, 7, 8, 9, 10]
    rows = [(k, v, 0, "a", 1, "b") for k, v in zip(ids, vectors)]
    found = whiten_embeddings(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in found) == sorted((k, c) for k in (0, 1, 2, 2) for c in (1, 2))
    assert {r["n"] for r in found} == {3}
    *_, deviation = _expected([(1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, [0.5, -3.0])])
    assert {r["vec_id"]: r["deviation"] for r in found} == {1: deviation[1], 2: deviation[2], None: deviation[3]}
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert whiten_embeddings(same).collect() == []
    assert whiten_embeddings(same.limit(0)).collect() == []
    assert whiten_embeddings(same.limit(0)).columns == whiten_embeddings(same).columns

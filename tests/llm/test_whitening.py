"""Whitening against a dense eigenvalue solver."""

import numpy as np
import pytest

from citemill.llm import whitening
from citemill.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, x string, size int, place int, n string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "x", 2, 3, "n") for i, v in vectors], SCHEMA)


def brute(vectors, k=8):
    """(id, component) -> (n, deviation, |whitened|, explained), by the covariance as a matrix."""
    usable = [
        (i, v) for i, v in vectors if v and all(c is not None and np.isfinite(c) for c in v)
    ]
    x = np.floor(1024 * np.array([v for _, v in usable], dtype=np.float32).astype(float)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    white = np.abs(centred @ vectors / np.sqrt(values))
    trace = (centred**2).sum() / n
    return sorted(
        (i, c + 1, n, sum((n * int(v) - int(s)) ** 2 for v, s in zip(x[r], sums)), white[r, c], values[c] / trace)
        for r, (i, _) in enumerate(usable)
        for c in range(min(k, x.shape[1]))
    )


def check(df, expected):
    rows = sorted(
        (r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained, r.identity_error) for r in df.collect()
    )
    assert [r[:4] for r in rows] == [e[:4] for e in expected]
    assert np.allclose([r[4] for r in rows], [e[4] for e in expected], rtol=1e-8, atol=1e-8)
    assert np.allclose([r[5] for r in rows], [e[5] for e in expected], rtol=1e-12)
    assert {r[6] for r in rows} and max(r[6] for r in rows) < 1e-10


def test_given_vectors(spark):
    folder = "/root/testdata/sf0.001"
    given = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    check(QUERIES["op11_jacobi_davidson"](spark, folder), brute(given))


def test_odd_rows_are_dropped(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, rng.standard_normal(5).tolist()) for i in range(40)]
    vectors += [(40, vectors[0][1]), (40, vectors[0][1]), (41, None), (42, []), (43, [1.0, None, 2.0, 3.0, 4.0])]
    vectors += [(44, [1.0, float("nan"), 2.0, 3.0, 4.0]), (45, [float("inf")] * 5)]
    check(whitening.whiten(frame(spark, vectors)), brute(vectors))
    # Vectors of a rarer length have no place in the covariance.
    check(whitening.whiten(frame(spark, [*vectors, (46, [1.0, 2.0])])), brute(vectors))


def test_a_null_id_stays(spark):
    vectors = [(i if i else None, [float(i), float(i * i % 7)]) for i in range(9)]
    rows = whitening.whiten(frame(spark, vectors)).collect()
    assert sorted(r.component for r in rows if r.vec_id is None) == [1, 2]


def test_as_many_components_as_directions(spark):
    vectors = [(i, [float(i), 2.0 * i, 5.0]) for i in range(12)]
    rows = whitening.whiten(frame(spark, vectors)).collect()
    assert {r.component for r in rows} == {1} and len(rows) == 12
    assert all(abs(r.explained - 1) < 1e-12 for r in rows)


def test_rows_that_do_not_vary(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(frame(spark, [(1, None)])).collect() == []


def test_sums_by_shuffle(spark, monkeypatch):
    vectors = [(i, [float(v) for v in np.random.default_rng(i).standard_normal(6)]) for i in range(50)]
    monkeypatch.setattr(whitening, "FEW_TASKS", 0)
    check(whitening.whiten(frame(spark, vectors).repartition(3)), brute(vectors))


@pytest.mark.parametrize("d", [1, 2, 9, 30, 200])
def test_solver(d):
    rng = np.random.default_rng(d)
    a = rng.standard_normal((500, d)) * np.linspace(1, 3, d)
    a -= a.mean(axis=0)
    dense = a.T @ a / len(a)
    calls = []

    def product(block):
        calls.append(block.shape[1])
        return a.T @ (a @ block) / len(a)

    values, vectors = whitening.largest_eigenpairs(product, d, 8)
    expected = np.linalg.eigvalsh(dense)[::-1][:8]
    assert np.allclose(values, expected, rtol=1e-13)
    assert np.abs(dense @ vectors - vectors * values).max() < 1e-13 * values[0] * 10
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-13)
    # Never more columns at once than the block, however many dimensions.
    assert max(calls) <= whitening.BLOCK


def test_equal_and_close_eigenvalues():
    for spectrum in ([5, 5, 5, 4, 4, 3, 3, 3, 3, 3, *[1] * 40], [1 + 1e-9 * i for i in range(40)], [1e12, *[1] * 30]):
        q = np.linalg.qr(np.random.default_rng(1).standard_normal((len(spectrum),) * 2))[0]
        dense = (q * np.array(spectrum)) @ q.T
        values, vectors = whitening.largest_eigenpairs(lambda b: dense @ b, len(spectrum), 8)
        assert np.allclose(values, sorted(spectrum, reverse=True)[:8], rtol=0, atol=1e-13 * max(spectrum))
        assert np.abs(dense @ vectors - vectors * values).max() <= 1e-13 * max(spectrum)


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.standard_normal((12, 12)))[0]
    dense = (q * np.array([-3, -2, -1, 1, 2, 3, 4, 5, 6, 7, 8, 9.0])) @ q.T
    rhs = rng.standard_normal((12, 3))
    found = whitening.minres(lambda b: dense @ b, rhs, 40, 1e-12)
    assert np.abs(dense @ found - rhs).max() < 1e-9


def test_deviations_beyond_a_long():
    exact, beyond = whitening.deviations(np.array([[3, 4], [1 << 40, 1 << 40], [1 << 31, 0]]))
    assert exact.tolist() == [25, 0, 1 << 62] and beyond.tolist() == [False, True, False]

"""Components against a dense eigensolver, exact deviations, and the cases at the edge."""

import numpy as np
import pytest

from eventloom.llm import catalog, whitening

SF = "/root/testdata/sf0.01"


def dense(vectors):
    x = np.floor(64 * np.asarray(vectors, float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    away = n * x - s
    c = away / n
    e, u = np.linalg.eigh(c.T @ c / n)
    return away, c, e[::-1], u[:, ::-1]


def matrix(rows, k):
    return np.array([r.whitened for r in sorted(rows, key=lambda r: (r.vec_id, r.component))]).reshape(-1, k)


@pytest.mark.parametrize("spread", [np.linspace(3, 0.5, 300), 0.9 ** np.arange(300), np.r_[np.ones(40), np.zeros(260)]])
def test_solver_against_a_dense_one(spread):
    x = np.random.default_rng(0).standard_normal((2000, 300)) * spread
    v = x.T @ x / len(x)
    calls = []
    values, vectors = whitening.jacobi_davidson(lambda b: calls.append(1) or v @ b, 300, 32)
    true = np.linalg.eigvalsh(v)[::-1][:32]
    assert np.abs(values - true).max() < 1e-13 * true[0]
    assert np.linalg.norm(v @ vectors - vectors * values, axis=0).max() < 1e-12 * true[0]
    assert np.abs(vectors.T @ vectors - np.eye(32)).max() < 1e-12 and len(calls) < 300


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    a = q * np.r_[np.linspace(1, 2, 15), -np.linspace(1, 2, 15)] @ q.T
    b = rng.standard_normal((30, 4))
    assert np.abs(a @ whitening.minres(lambda x: a @ x, b, 60, 1e-13) - b).max() < 1e-9


def test_query_against_a_dense_solver(spark):
    rows = catalog.op11_jacobi_davidson(spark, SF).collect()
    vectors = [r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()]
    away, c, e, u = dense(vectors)
    assert len(rows) == 32 * len(vectors) and {r.n for r in rows} == {len(vectors)}
    assert {r.vec_id: r.deviation for r in rows} == dict(enumerate((away * away).sum(1).tolist()))
    mine, true = matrix(rows, 32), c @ u[:, :32] / np.sqrt(e[:32])
    assert np.abs(mine * np.sign((mine * true).sum(0)) - true).max() < 1e-9
    assert np.allclose([r.explained for r in sorted(rows, key=lambda r: r.component)[::len(vectors)]], e[:32] / e.sum(), rtol=1e-9)
    assert {r.identity_error for r in rows} == {max(r.identity_error for r in rows)} and rows[0].identity_error < 1e-9


def test_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [0.5, 1.0, 0.0]), (1, [0.5, 1.0, 0.0]), (None, [0.1, -1.0, 2.0]), (3, [9.0, 0.25, 1.0]), (4, None), (5, [1.0, None, 2.0]), (6, [1.0, nan, 2.0]),
            (7, [inf, 1.0, 2.0]), (8, []), (9, [1.0, 2.0]), (10, [1e300, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS Component", "'x' AS whitened_", "2 AS n")
    found = whitening.whiten(df).collect()
    assert sorted(str(r.vec_id) for r in found if r.component == 1) == ["1", "1", "3", "None"] and {r.n for r in found} == {4} and {r.component for r in found} == {1, 2, 3}
    x = np.floor(64 * np.array([rows[0][1], rows[1][1], rows[2][1], rows[3][1]])).astype(int)
    assert {r.deviation for r in found} == {int(v) for v in ((4 * x - x.sum(0)) ** 2).sum(1)}
    one = whitening.whiten(df.filter("vec_id = 3")).collect()
    assert [(r.component, r.whitened, r.explained, r.deviation) for r in one] == [(k, None, 0.0, 0) for k in (1, 2, 3)]
    assert whitening.whiten(df.limit(0)).count() == 0 and whitening.whiten(df.filter("vec_id = 4")).columns == whitening.whiten(df).columns
    wide = spark.createDataFrame([(k, [float(k) * 2.0 ** 38, float(k % 7)]) for k in range(50)], "vec_id string, embedding array<double>")
    found = whitening.whiten(wide).collect()
    assert {type(r.vec_id) for r in found} == {str} and found[0].identity_error < 1e-9
    true = [sum((50 * a - b) ** 2 for a, b in zip((64 * k * 2 ** 38, 64 * (k % 7)), (64 * 2 ** 38 * 1225, 64 * sum(k % 7 for k in range(50))), strict=True)) for k in range(50)]
    assert {int(r.vec_id): r.deviation for r in found} == {k: v if v < 2 ** 63 else None for k, v in enumerate(true)}

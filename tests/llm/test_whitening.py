import numpy as np
import pytest
from pyspark.sql import functions as F

from objsync.llm import whitening as w
from objsync.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, components=16):
    """Covariance and eigenvectors of the distinct vectors by a dense solver."""
    x = {i: [int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for i, v in rows
         if v is not None and v and all(c is not None and np.isfinite(c) for c in v)}
    listed = np.array(sorted(set(map(tuple, x.values()))), dtype=object)
    n, sums = len(listed), listed.sum(axis=0)
    centred = (listed * n - sums).astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = {}
    for i, v in x.items():
        moved = np.array(v, dtype=object) * n - sums
        deviation = sum(int(m) ** 2 for m in moved)
        for k, value in enumerate(values):
            out[i, k + 1] = (n, deviation, moved.astype(float) / n @ vectors[:, k] / np.sqrt(value), value / np.var(centred, axis=0).sum())
    return out


def whitened(df):
    vectors = df.select("*", w.integers(F.col("embedding")).alias("vector"))
    return w.whiten(vectors, *w.fit(vectors)).collect()


def check(got, want):
    assert {(r["vec_id"], r["component"]) for r in got} == set(want)
    signs = {}
    for r in got:
        n, deviation, value, explained = want[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert r["explained"] == pytest.approx(explained, rel=1e-9) and r["identity_error"] < 1e-9
        if abs(value) > 1e-6:
            signs.setdefault(r["component"], np.sign(value) * np.sign(r["whitened"]))
        assert r["whitened"] * signs.get(r["component"], 1) == pytest.approx(value, abs=1e-6)


def test_against_a_dense_solver(make):
    rng = np.random.default_rng(5)
    rows = [(k, [float(c) for c in rng.normal(size=20) * np.linspace(1, 3, 20)]) for k in range(300)]
    rows += [(1000 + k, rows[7][1]) for k in range(200)]  # copies count once
    odd = [(2000, None), (2001, []), (2002, [None] * 20), (2003, [float("nan")] * 20), (2004, [float("inf")] * 20), (2005, [1.0] * 19)]
    check(whitened(make(rows + odd, SCHEMA, clash=True)), brute(rows))


def test_few_rows_ties_and_constants(make):
    assert whitened(make([], SCHEMA)) == []
    assert whitened(make([(1, None)], SCHEMA)) == []
    assert whitened(make([(1, [0.5, 0.5]), (2, [0.5, 0.5])], SCHEMA)) == []  # no spread, so no direction
    line = [(None, [float(k), 2.0 * k, 3.0]) for k in range(5)] + [(9, [0.0, 0.0, 3.0])] * 2
    got = whitened(make(line, SCHEMA))
    assert len(got) == 7 and {r["component"] for r in got} == {1}  # one direction; repeated rows each count
    assert all(r["identity_error"] < 1e-9 for r in got)


def test_equal_eigenvalues_and_large_entries(make):
    rows = [(k, [1.0 if k % 6 == d else 0.0 for d in range(6)]) for k in range(12)]
    got = whitened(make(rows, SCHEMA))
    assert {r["component"] for r in got} == set(range(1, 6)) and all(r["identity_error"] < 1e-9 for r in got)
    huge = [(k, [3e38 if k % 2 else -3e38, float(k)]) for k in range(8)]
    got = whitened(make(huge, SCHEMA))
    assert all(r["deviation"] is None for r in got) and len(got) >= 8


@pytest.mark.parametrize("matrix", [
    np.eye(7), np.zeros((3, 3)), np.diag(10.0 ** -np.arange(12)),
    np.diag(np.abs(np.arange(-10, 11)).astype(float)) + np.eye(21, k=1) + np.eye(21, k=-1),
    np.linalg.qr(np.random.default_rng(1).normal(size=(90, 40)), mode="r"),
    np.vander(np.linspace(0.1, 1, 12)),
])
def test_singular_values_and_vectors(matrix):
    values, vectors = w.singular(matrix)
    known = np.linalg.svd(matrix, compute_uv=False)
    assert np.allclose(values, known, rtol=1e-12, atol=1e-14 * max(known.max(), 1e-300))
    assert np.abs(vectors.T @ vectors - np.eye(len(matrix))).max() < 1e-11
    assert np.abs(matrix.T @ (matrix @ vectors) - vectors * values**2).max() <= 1e-12 * max(known.max() ** 2, 1e-300)


def test_qd_keeps_small_values_accurate():
    a = np.array([1.0, 1e-3, 1e-6, 1e-9])
    b = np.array([0.5, 5e-4, 5e-7])
    product = np.prod(a)
    assert np.prod(np.sqrt(w.qd_values(a**2, b**2))) == pytest.approx(product, rel=1e-13)


def test_query(llm):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in llm.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(QUERIES["op12_qd_whitening"](llm, sf).collect(), brute(rows))

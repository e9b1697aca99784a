"""Whitening against plain double-precision algebra, and the refinement against planted spectra."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest

from shopfloor.llm import whitening
from shopfloor.llm.registry import op11_whitening


def brute(vectors):
    """Rows of ``n, deviation, whitened, explained`` per vector by Python integers and numpy."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    points = sorted({tuple(v) for v in x})
    n, sums = len(points), [sum(c) for c in zip(*points)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in points])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    mine = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in x])
    return n, deviation, mine @ axes[:, :16] / np.sqrt(values[:16]), values[:16] / values.sum()


def test_query_equals_plain_algebra(spark, data):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{data}/embeddings.parquet' ORDER BY vec_id").fetchall()
    n, deviation, white, explained = brute([r[1] for r in rows])
    got = op11_whitening(spark, data).orderBy("vec_id", "component").collect()
    assert len(got) == 16 * len(rows)
    found = np.array([r["whitened"] for r in got]).reshape(-1, 16)
    signs = np.sign((found * white).sum(axis=0))
    assert np.abs(found * signs - white).max() < 1e-8
    assert {r["n"] for r in got} == {n}
    assert [r["deviation"] for r in got[::16]] == deviation
    assert np.allclose([r["explained"] for r in got[:16]], explained, rtol=1e-12)
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-10


def planted(values, seed=0):
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0].astype(np.longdouble)
    for _ in range(4):
        q = q @ (1.5 * np.eye(len(values), dtype=np.longdouble) - 0.5 * (q.T @ q))
    matrix = (q * np.array(values, dtype=np.longdouble)) @ q.T
    return (matrix + matrix.T) / 2, q


@pytest.mark.parametrize(
    "values",
    [
        [64, 32, 16, 8, 4, 2, 1],
        [5, 5 - 1e-4, 5 - 2e-4, 1, 0.5],
        [7, 7 - 1e-9, 7 - 2e-9, 7 - 1e-5, 3, 3 - 1e-8, 1],
        [2, 2 - 1e-12, 1, 1 - 1e-12, 1e-6, 1e-7],
        list(np.linspace(60, 59.99, 48)),
        [1e9, 1.0, 1e-3, 1e-6],
    ],
)
def test_clusters_are_told_apart(values):
    matrix, q = planted(values)
    got, x = whitening.eigenvectors(matrix)
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-17
    assert np.abs(matrix @ x - x * got).max() < 1e-17 * max(values)
    assert np.abs(got - np.array(values, dtype=np.longdouble)).max() < 1e-17 * max(values)
    gaps = min(abs(a - b) for i, a in enumerate(values) for b in values[i + 1 :])
    assert np.abs(x - q * np.sign((x * q).sum(axis=0))).max() < max(1e-15, 2e-17 * max(values) / gaps)


def test_refinement_is_what_makes_it_exact():
    matrix, _ = planted(list(np.linspace(10, 9.9, 32)), 4)
    rough = np.linalg.eigh((matrix / np.abs(matrix).max()).astype(np.float32))[1].astype(np.longdouble)
    assert np.abs(rough.T @ rough - np.eye(32)).max() > 1e-9
    _, once = whitening.eigenvectors(matrix, refinements=1)
    _, done = whitening.eigenvectors(matrix)
    off = [np.abs((s := x.T @ matrix @ x) - np.diag(np.diag(s))).max() for x in (rough, once, done)]
    assert off[0] > 10 * off[1] and off[1] > 1e6 * off[2]


def test_equal_eigenvalues():
    for values in ([3, 3, 3, 1], [0, 0, 0], [2.0] * 20, [4, 0, 0]):
        matrix, _ = planted(values, 2)
        got, x = whitening.eigenvectors(matrix)
        assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-17
        assert np.abs(got - np.array(sorted(values, reverse=True))).max() < 1e-16


def test_gram_is_exact_for_large_entries():
    for size in (10, 2**20, 2**27, 2**40):
        y = np.random.default_rng(1).integers(-size, size, (50, 3))
        assert (whitening._gram(y) == y.astype(object).T @ y.astype(object)).all()


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, x int, n string")


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def test_defined_rows(spark):
    bad = [
        (1, None), (2, []), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [1e30, 1.0]),
    ]
    good = [(7, [0.5, 1.0]), (7, [0.5, 1.0]), (8, [0.5, 1.0]), (None, [1.5, 0.0]), (9, [-2.0, 0.25]), (10, [0.0, -0.0])]
    got = collected(whitening.whiten(table(spark, [(i, v, 0, "n") for i, v in bad + good])))
    n, deviation, white, explained = brute([v for _, v in good])
    assert n == 4 and [r[0] for r in got] == [None, None, 7, 7, 7, 7, 8, 8, 9, 9, 10, 10]
    assert {int(r[3]) for r in got if r[0] == 9} == {deviation[4]}
    for component in (1, 2):
        mine = np.array([next(r[4] for r in got if r[0] == i and r[1] == component) for i in (7, 8, 9, 10)])
        theirs = white[[0, 2, 4, 5], component - 1]
        assert np.allclose(mine, theirs) or np.allclose(mine, -theirs)
    assert {r[2] for r in got} == {4}


def test_without_variance(spark):
    one = collected(whitening.whiten(table(spark, [(1, [0.5, 0.5], 0, "n")] * 3)))
    assert one == [(1, c, 1, 0, None, None, None) for c in (1, 1, 1, 2, 2, 2)]
    line = collected(whitening.whiten(table(spark, [(i, [float(i), 1.0, 2.0 * i], 0, "n") for i in range(5)])))
    assert [(r[4] is None, r[5] > 0) for r in line] == [(False, True), (True, False), (True, False)] * 5
    assert all(r[6] < 1e-12 for r in line)
    assert whitening.whiten(table(spark, [])).count() == 0


def test_lengths_are_fitted_apart(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(2 + i % 2).tolist(), 0, "n") for i in range(40)]
    got = collected(whitening.whiten(table(spark, rows)))
    assert {(r[0] % 2, r[2]) for r in got} == {(0, 20), (1, 20)}
    assert {r[0] % 2: r[1] for r in got} == {0: 2, 1: 3}
    assert all(r[6] < 1e-10 for r in got)


def test_wide_values_and_copies(spark):
    """Far from zero, and with a third of the rows on one vector."""
    rng = np.random.default_rng(3)
    vectors = (rng.standard_normal((300, 5)) * [1, 10, 100, 1000, 1e6] + [1e3, 1e3, 1e4, 1e5, 1e9]).astype(np.float32).tolist()
    rows = [(i, v, 0, "n") for i, v in enumerate(vectors + [vectors[0]] * 150)]
    got = collected(whitening.whiten(table(spark, rows)))
    n, deviation, white, _ = brute([r[1] for r in rows])
    assert {r[2] for r in got} == {n}
    assert [int(r[3]) for r in got[::5]] == deviation
    assert got[0][6] < 1e-9
    found = np.array([r[4] for r in got]).reshape(-1, 5)
    assert np.abs(found[0] - found[300:]).max() == 0

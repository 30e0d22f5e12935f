"""Whitening against numpy's symmetric solver, and on awkward vectors."""

from __future__ import annotations

import math

import numpy as np
import pytest
from conftest import SF

from kerbside.llm import whitening
from kerbside.llm.common import table

ROWS = "vec_id long, embedding array<float>, label int, x string, n long, component int"


def usable(rows):
    """(vec_id, whole numbers) of the rows that stay."""
    out = []
    for i, v in rows:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            out.append((i, [math.floor(256 * c) for c in v]))
    width = max((len(x) for _, x in out), default=0)
    return [(i, x + [0] * (width - len(x))) for i, x in out]


def brute(rows):
    kept = usable(rows)
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    y = np.array([[n * a - s for a, s in zip(x, sums, strict=True)] for x in fit], float) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(-values)[:4]
    deviation = {i: sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)) for i, x in kept}
    white = {
        i: (np.array([n * a - s for a, s in zip(x, sums, strict=True)], float) / n)
        @ vectors[:, order] / np.sqrt(values[order]) for i, x in kept}
    return n, deviation, white, values[order] / values.sum()


def check(found, rows):
    n, deviation, white, explained = brute(rows)
    size = len(explained)
    assert len(found) == size * len(usable(rows))
    assert {(r.vec_id, r.component) for r in found} == {
        (i, c + 1) for i in deviation for c in range(size)}
    for c in range(size):
        mine = [r for r in found if r.component == c + 1]
        assert all(r.n == n and r.deviation == deviation[r.vec_id] for r in mine)
        assert all(r.explained == pytest.approx(explained[c], rel=1e-9) for r in mine)
        a = np.array([r.whitened for r in mine])
        b = np.array([white[r.vec_id][c] for r in mine])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-6
    assert all(0 <= r.identity_error < 1e-9 for r in found)


def test_whitened_like_the_symmetric_solver(spark):
    source = table(spark, SF, "embeddings")
    found = whitening.whiten(source).collect()
    check(found, [(r.vec_id, r.embedding) for r in source.collect()])


def test_awkward_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=6).astype(np.float32).tolist()) for k in range(40)]
    rows += [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (102, [nan] * 6),
             (103, [0.0, inf, 0.0, 0.0, 0.0, 0.0]), (104, [-inf] * 6), (105, [1.5, -2.25]),
             (106, []), (7, rows[7][1]), (107, rows[7][1])]  # copies count once in the fit
    docs = spark.createDataFrame([(i, v, 0, "x", 1, 9) for i, v in rows], ROWS).repartition(5)
    found = whitening.whiten(docs).collect()
    assert len(found) == 4 * 44
    check([r for r in found if r.vec_id != 7], [(i, v) for i, v in rows if i != 7])
    twice = [r for r in found if r.vec_id == 7]
    assert len(twice) == 8 and len({(r.component, r.whitened) for r in twice}) == 4


@pytest.mark.parametrize("rows", [
    [], [(1, None), (2, [float("nan")])], [(1, []), (2, [])]])
def test_nothing_to_fit(spark, rows):
    docs = spark.createDataFrame([(i, v, 0, "", 0, 0) for i, v in rows], ROWS)
    assert whitening.whiten(docs).collect() == []


def test_directions_without_variance(spark):
    one = spark.createDataFrame([(1, [0.5, 1.0], 0, "", 0, 0), (2, [0.5, 1.0], 0, "", 0, 0)], ROWS)
    found = whitening.whiten(one).orderBy("vec_id", "component").collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained) for r in found] == [
        (i, c, 1, 0, None, None) for i in (1, 2) for c in (1, 2)]
    line = spark.createDataFrame(
        [(k, [float(k), 2.0 * k, 3.0], 0, "", 0, 0) for k in range(5)], ROWS)
    found = whitening.whiten(line).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in found)
    assert all(r.identity_error < 1e-12 for r in found)


def test_large_numbers_stay_exact_or_are_null(spark):
    rows = [(k, [1e12 * (k + 1), float(k)]) for k in range(3)]
    docs = spark.createDataFrame([(i, v, 0, "", 0, 0) for i, v in rows],
                                 ROWS.replace("float", "double"))
    assert {r.deviation for r in whitening.whiten(docs).collect() if r.vec_id == 0} == {None}
    assert {r.deviation for r in whitening.whiten(docs).collect() if r.vec_id == 1} == {0}


@pytest.mark.parametrize("matrix", [
    np.eye(7), np.diag([3, 3, 2, 2, 1.0]), np.ones((5, 5)), np.zeros((4, 4)),
    np.kron(np.eye(3), np.ones((4, 4))), np.triu(np.ones((30, 30))),
    np.diag(np.abs(np.arange(21) - 10.0)) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1),
    np.random.default_rng(1).normal(size=(64, 64)) * np.geomspace(1, 1e-9, 64),
], ids=range(8))
def test_qd_solver(matrix):
    values, vectors = whitening.principal(matrix, 4)
    want = np.maximum(np.linalg.eigvalsh(matrix.T @ matrix)[::-1][:4], 0)
    top = max(want[0], 1e-300)
    assert np.abs(values - want).max() <= 1e-13 * top
    assert np.abs(vectors @ vectors.T - np.eye(len(vectors))).max() < 1e-14
    for value, z in zip(values, vectors, strict=True):
        assert np.linalg.norm(matrix.T @ (matrix @ z) - value * z) <= 1e-13 * top


def test_small_singular_values_keep_their_digits():
    """Those of a graded bidiagonal matrix, against the exact product of its diagonal."""
    diagonal, above = np.geomspace(1, 1e-6, 12), np.geomspace(1, 1e-6, 12)[:-1] / 3
    values = whitening.dqds(diagonal, above)
    assert np.prod(values) == pytest.approx(np.prod(diagonal) ** 2, rel=1e-12)

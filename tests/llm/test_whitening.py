"""Jacobi-Davidson whitening against numpy's dense solver."""

import numpy as np
import pytest

from strata.llm import whitening

RNG = np.random.default_rng(4)


@pytest.mark.parametrize("spectrum", ["flat", "falling", "equal", "low"])
@pytest.mark.parametrize("d", [3, 40, 200])
def test_leading_pairs(d, spectrum):
    values = {
        "flat": np.linspace(90, 110, d),
        "falling": 100 * 0.93 ** np.arange(d),
        "equal": np.repeat([50.0, 20.0, 1.0, 0.0], -(-d // 4))[:d],
        "low": np.where(np.arange(d) < 2, 5.0, 0.0),
    }[spectrum]
    q, _ = np.linalg.qr(RNG.standard_normal((d, d)))
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    for k in (1, 8, 32):
        got, vectors = whitening.leading(lambda b: a @ b, d, k)
        want = np.sort(values)[::-1][: min(k, d)]
        assert len(got) == min(k, d) and np.abs(got - want).max() < 1e-11
        assert np.linalg.norm(a @ vectors - vectors * got, axis=0).max() < 3e-14 * want[0] * max(1, d / 50)
        assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-13


def test_corrections_solve_the_projected_equation():
    d = 30
    a = RNG.standard_normal((d, d))
    a = a + a.T
    basis, _ = np.linalg.qr(RNG.standard_normal((d, 3)))
    shifts, residual = np.array([40.0, -35.0, 31.0]), RNG.standard_normal((d, 3))
    z = whitening.corrections(lambda b: a @ b, shifts, residual, basis, 200, 1e-13)
    project = np.eye(d) - basis @ basis.T
    for j, shift in enumerate(shifts):
        left = project @ (a - shift * np.eye(d)) @ project @ z[:, j]
        assert np.abs(left + project @ residual[:, j]).max() < 1e-9
    assert np.abs(basis.T @ z).max() < 1e-12


def _table(spark, rows, extra=""):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<float>{extra}")


def _check(got, vectors, components):
    x = np.floor(64 * np.array([v for _, v in vectors], np.float32).astype(float)).astype(np.int64) + 1000000
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s) / n
    v = c.T @ c / n
    values, q = np.linalg.eigh(v)
    values, q = values[::-1][:components], q[:, ::-1][:, :components]
    white = c @ q / np.sqrt(values)
    rows = sorted(got, key=lambda r: r.component)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.vec_id, []).append(r)
    assert len(rows) == n * len(values)
    deviation = {i: int(d) for (i, _), d in zip(vectors, ((n * x - s) ** 2).sum(axis=1), strict=True)}
    mine = np.array([[r.whitened for r in by_id[i]] for i, _ in vectors])
    sign = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine * sign - white).max() < 1e-8
    for i, _ in vectors:
        assert [r.component for r in by_id[i]] == list(range(1, len(values) + 1))
        assert {(r.n, r.deviation) for r in by_id[i]} == {(n, deviation[i])}
        assert np.allclose([r.explained for r in by_id[i]], values / np.trace(v), rtol=1e-12)
    assert {r.identity_error for r in rows} == {rows[0].identity_error} and rows[0].identity_error < 1e-10


def test_whitened_vectors(spark, monkeypatch):
    vectors = [(i, (RNG.standard_normal(40) * np.linspace(0.2, 2, 40)).astype(np.float32).tolist()) for i in range(150)]
    bad = [(900, None), (901, [None] * 40), (902, [float("nan")] * 40), (903, [float("inf")] + [0.0] * 39), (904, []), (905, [1.0])]
    bad += [(906, [1e30] * 40)]
    # columns whose names the operator uses inside
    docs = _table(spark, [(i, v, 1, 2.0) for i, v in vectors + bad], ", x int, e double").repartition(5)
    _check(whitening.whiten(spark, docs).collect(), vectors, 32)
    monkeypatch.setattr(whitening, "FOLDS", 2)  # sums folded by a second stage
    _check(whitening.whiten(spark, docs, components=5).collect(), vectors, 5)


def test_repeated_rows_ties_and_null_ids(spark):
    base = [RNG.standard_normal(6).round(2).tolist() for _ in range(30)]
    rows = [(i, v) for i, v in enumerate(base)] + [(3, base[3]), (None, base[4]), (None, base[4])]
    got = whitening.whiten(spark, _table(spark, rows), components=3).collect()
    assert len(got) == 3 * 33 and sum(r.vec_id is None for r in got) == 6 and {r.n for r in got} == {33}


def test_rank_deficient_equal_single_and_empty(spark):
    line = [(i, [float(i), 2.0 * i, 1.0]) for i in range(10)]
    got = whitening.whiten(spark, _table(spark, line)).collect()
    assert {r.component for r in got} == {1} and len(got) == 10 and abs(got[0].explained - 1) < 1e-12
    assert whitening.whiten(spark, _table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(spark, _table(spark, [(1, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(spark, _table(spark, [])).count() == 0
    columns = whitening.whiten(spark, _table(spark, [])).columns
    assert columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviations_beyond_a_long():
    centre = whitening.Centre(3, [3 * 10**12 + 1, 0])
    x = np.array([[10**12, 0], [10**12 + 2 * 10**9, 1], [0, 0]], np.int64)
    want = [sum((3 * int(v) - s) ** 2 for v, s in zip(row, (3 * 10**12 + 1, 0), strict=True)) for row in x]
    assert centre.deviations(x) == [w if w < 2**63 else None for w in want] and want[2] >= 2**63

"""Whitening against exact sums and a dense eigensolver."""

from fractions import Fraction
from math import floor

import numpy as np
import pytest

from ledgerlens.llm import whitening
from ledgerlens.sources import Scratch

SCHEMA = "vec_id long, embedding array<double>, x string, n int, component string, place int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, "x", 1, "c", 2) for i, v in vectors], SCHEMA)


def expected(vectors):
    """(rows of x by place, n, S, covariance) by plain arithmetic."""
    rows = [(i, tuple(floor(c * 256) for c in v)) for i, v in vectors if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({x for _, x in rows})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    v = [[Fraction(sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for x in fit), n**3) for j in range(d)] for i in range(d)]
    return rows, fit, n, sums, np.array([[float(c) for c in row] for row in v])


@pytest.mark.parametrize("scale", [1.0, 1e12])
def test_matches_brute_force(spark, scale):
    random = np.random.default_rng(3)
    x = random.normal(size=(60, 6)) * [5, 3, 2, 1, 0.5, 0.1] * scale
    vectors = [(i, v.tolist()) for i, v in enumerate(x)]
    vectors += [(100 + i, vectors[0][1]) for i in range(40)] + [(None, vectors[1][1]), (0, vectors[2][1]), (7, [-0.0] * 6), (8, [0.0] * 6)]
    odd = [None, [], [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf")] * 6, [1.0, 2.0]]
    got = whitening.whiten(table(spark, vectors + [(900 + i, v) for i, v in enumerate(odd)]), Scratch(spark, "w")).collect()
    rows, fit, n, sums, v = expected(vectors)
    values, components = np.linalg.eigh(v)
    values, components = values[::-1][:4], components[:, ::-1][:, :4]
    assert len(got) == 4 * len(rows) and {r.n for r in got} == {n} and {r.vec_id for r in got} == {i for i, _ in rows}
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation, r.component), []).append(r)
    projected = {x: ((np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)])) @ components) / np.sqrt(values) for x in fit}
    signs = {}
    for i, x in rows:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        if deviation >= 1 << 63:
            deviation = None
        for c in range(4):
            # With the component's one sign, the nearest of the rows of this id is this row.
            sign = signs.setdefault(c, 1 if min(abs(r.whitened - projected[x][c]) for r in by[i, deviation, c + 1]) < 1e-9 else -1)
            r = min(by[i, deviation, c + 1], key=lambda r: abs(sign * r.whitened - projected[x][c]))
            assert abs(sign * r.whitened - projected[x][c]) < 1e-9
            assert abs(r.explained - values[c] / np.trace(v)) < 1e-12 and r.identity_error < 1e-9
    assert scale > 1 or all(r.deviation is not None for r in got)


def test_few_dimensions_and_no_variance(spark):
    flat = [(i, [float(i), 2.0 * i, 3.0]) for i in range(5)]
    got = whitening.whiten(table(spark, flat), Scratch(spark, "w")).collect()
    assert len(got) == 5 and {r.component for r in got} == {1} and all(abs(r.explained - 1) < 1e-12 for r in got)
    assert sorted(round(abs(r.whitened), 6) for r in got) == [0, 0.707107, 0.707107, 1.414214, 1.414214]
    for none in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(3)]):
        empty = whitening.whiten(table(spark, none), Scratch(spark, "w"))
        assert empty.count() == 0 and len(empty.columns) == 7
    # Beside entries at the ends of 64 bits the other direction is rounding.
    huge = [(i, [1e300 * i, 1.0 * i * i]) for i in range(4)]
    assert whitening.whiten(table(spark, huge), Scratch(spark, "w")).count() == 4


@pytest.mark.parametrize("d", [1, 2, 5, 40])
def test_components_of_all_kinds_of_spectra(d):
    random = np.random.default_rng(d)
    turn = np.linalg.qr(random.normal(size=(d, d)))[0]
    places = np.arange(d)
    for spectrum in (
        np.ones(d),
        2.0**-places,
        10.0 ** -np.minimum(places, 300),
        random.random(d),
        1 + 1e-9 * random.random(d),
        (places == 0) * 1.0,
        np.where(places < 6, 1 + 1e-12 * places, 0.99),
    ):
        m = turn * spectrum @ turn.T * 7e3
        m = (m + m.T) / 2
        vectors, values = whitening.leading(m, 4)
        want = np.sort(spectrum * 7e3)[::-1][:4]
        want = want[want > 1e-15 * d * np.trace(m)][: len(values)]
        assert len(values) == len(want) and np.abs(values - want).max() < 1e-13 * np.trace(m)
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
        assert np.abs(m @ vectors - vectors * values).max() < 1e-12 * np.trace(m)
    assert whitening.leading(np.zeros((d, d)), 4)[1].size == 0


def test_inertia_counts_eigenvalues():
    random = np.random.default_rng(1)
    for d in (1, 2, 3, 17):
        m = random.normal(size=(d, d))
        m = m + m.T
        values = np.linalg.eigvalsh(m)
        counts = whitening.Inertia(m)
        for shift in [*random.normal(scale=3, size=20), *(values + 1e-9), *(values - 1e-9)]:
            assert counts.above(shift) == (values > shift).sum()


def test_a_missed_component_is_found(monkeypatch):
    """Where the filter loses an eigenvector, inertia tells, and the search goes on with more directions."""
    m = np.diag([4.0, 3.0, 2.0, 1.0, 0.5, 0.2, 0.1, 0.05, *np.linspace(0.01, 0.04, 20)])
    solve, calls = np.linalg.solve, []

    def blind(a, b):
        calls.append(b.shape[1])
        x = solve(a, b)
        x[1] = 0
        return x

    monkeypatch.setattr(whitening.np.linalg, "solve", blind)
    found = whitening._project(m, 1.5, 5.0, 3)
    assert calls[0] == 8 and calls[-1] == len(m)
    assert np.abs(np.abs(found).max(axis=1)[:3] - 1).max() < 1e-9 and found.shape[1] == 3
    monkeypatch.setattr(whitening, "_ROUNDS", 5)
    with pytest.raises(ArithmeticError):
        whitening._project(m, 1.5, 5.0, 3)

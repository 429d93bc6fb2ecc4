"""Whitening against numpy and exact integers."""

from fractions import Fraction

import numpy as np
import pytest

from trendlake.llm import whitening as w

SCHEMA = "vec_id long, embedding array<double>, id string, v string, deviation string, w string, pos string"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "i", "v", "d", "w", "p") for i, v in rows], SCHEMA).repartition(parts)


def brute(vectors):
    dim = max(map(len, vectors))
    x = [[int(np.floor(1024 * c)) + 100000 for c in list(v) + [0.0] * (dim - len(v))] for v in vectors]
    n, s = len(x), [sum(c) for c in zip(*x)]
    cov = np.array([[float(sum((Fraction(r[i]) - Fraction(s[i], n)) * (Fraction(r[j]) - Fraction(s[j], n)) for r in x) / n)
                     for j in range(dim)] for i in range(dim)])
    deviation = [sum((n * c - t) ** 2 for c, t in zip(r, s)) for r in x]
    values, axes = np.linalg.eigh(cov)
    centred = np.array([[float(Fraction(c) - Fraction(t, n)) for c, t in zip(r, s)] for r in x])
    return n, deviation, values[::-1], axes[:, ::-1], centred, np.trace(cov)


@pytest.mark.parametrize("scale", [1.0, 3e5])
def test_whitening(spark, scale):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(60, 10)) * np.linspace(2, 0.3, 10) * scale
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    n, deviation, values, axes, centred, trace = brute(vectors.tolist())
    got = {(r.vec_id, r.component): r for r in w.whiten(table(spark, rows)).collect()}
    assert len(got) == 60 * 8 and {r.n for r in got.values()} == {60}
    assert {r.identity_error for r in got.values()} == {next(iter(got.values())).identity_error}
    assert next(iter(got.values())).identity_error < 1e-9
    for k in range(8):
        want = centred @ axes[:, k] / np.sqrt(values[k])
        have = np.array([got[i, k + 1].whitened for i in range(60)])
        assert np.allclose(have, want * np.sign(have @ want), atol=1e-9)
        assert got[0, k + 1].explained == pytest.approx(values[k] / trace, rel=1e-12)
    assert [got[i, 1].deviation for i in range(60)] == [min(d, (1 << 63) - 1) for d in deviation]


def test_awkward_rows(spark):
    rng = np.random.default_rng(1)
    good = [(i, [float(c) for c in rng.normal(size=5)]) for i in range(20)]
    odd = [(None, [1.0, 2.0]), (7, [0.5] * 5), (7, [0.5] * 5), (30, [])]
    bad = [(40, None), (41, [None] + [1.0] * 4), (42, [float("nan")] * 5), (43, [float("inf")] + [0.0] * 4)]
    got = w.whiten(table(spark, good + odd + bad)).collect()
    n, deviation, values, *_ = brute([v for _, v in good + odd])
    assert len(got) == 24 * 5 and {r.n for r in got} == {24} and got[0].identity_error < 1e-9
    assert sorted(r.deviation for r in got if r.component == 1) == sorted(deviation)
    assert sum(r.vec_id is None for r in got) == 5 and sum(r.vec_id == 7 for r in got) == 15
    assert not {r.vec_id for r in got} & {40, 41, 42, 43}


def test_nothing_to_divide_by(spark):
    flat = table(spark, [(i, [1.0, 2.0, 3.0]) for i in range(4)])
    assert w.whiten(flat).count() == 0 and w.whiten(flat.limit(0)).count() == 0
    assert w.whiten(table(spark, [(1, [1.0, 5.0])])).count() == 0
    assert w.whiten(table(spark, [(1, []), (2, [])])).count() == 0
    # one direction only: one component
    line = w.whiten(table(spark, [(i, [1.0 * i, 2.0 * i, 0.0]) for i in range(6)])).collect()
    assert {r.component for r in line} == {1} and line[0].explained == pytest.approx(1.0)


def test_task_order_does_not_matter(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.normal(size=6)]) for i in range(50)]
    runs = [{(r.vec_id, r.component): (r.deviation, r.explained) for r in w.whiten(table(spark, rows, p)).collect()}
            for p in (1, 7)]
    assert runs[0] == runs[1]


def test_huge_entries_stay_exact(spark):
    rows = [(0, [1e18, 0.0]), (1, [-1e18, 1.0]), (2, [5.0, -1e300])]
    got = w.whiten(table(spark, rows)).collect()
    assert {r.deviation for r in got} == {(1 << 63) - 1} and got[0].identity_error < 1e-6


def test_inertia_counts(spark):
    rng = np.random.default_rng(0)
    for _ in range(200):
        d = rng.integers(1, 12)
        a = rng.integers(-2, 3, (d, d)).astype(float)
        a, shift = a + a.T, rng.choice([-1.0, 0.0, 0.5, rng.normal()])
        values = np.linalg.eigvalsh(a)
        if np.abs(values - shift).min() > 1e-9:
            assert w.above(a, shift) == (values > shift).sum()


def spectra():
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    for values in (np.r_[5, 5, 5, np.full(7, 4), np.ones(30)], np.r_[1e9, 1, 1 + 1e-9, 0.5, np.zeros(36)],
                   np.linspace(9, 1, 40), np.ones(40), 2.0 ** -np.arange(40), 1 + 1e-15 * np.arange(40)):
        a = q @ np.diag(values) @ q.T
        yield (a + a.T) / 2
    yield np.eye(3)
    yield np.ones((6, 6))
    yield np.array([[4.0]])


@pytest.mark.parametrize("a", list(spectra()))
def test_leading_eigenpairs(a):
    values, axes = w.leading(a)
    want = np.linalg.eigvalsh(a)[::-1][:8]
    scale = want[0]
    assert len(values) == (want > 40 * 40 * w.EPS * scale).sum()
    assert np.abs(values - want[:len(values)]).max() < 1e-13 * len(a) * scale
    assert np.abs(a @ axes - axes * values).max() < 1e-13 * len(a) * scale
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-12

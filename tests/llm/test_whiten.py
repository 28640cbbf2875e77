from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from inkwell.llm import whiten as w

SCHEMA = "vec_id long, embedding array<float>, x string, n int, dims int, component string"
finite = st.floats(-1e12, 1e12, allow_subnormal=False)


def vectors(kind, m):
    r = np.random.default_rng(m)
    a = r.normal(size=(m, m))
    return {
        "random": a @ a.T, "identity": np.eye(m), "zero": np.zeros((m, m)), "low rank": (x := r.normal(size=(m, max(1, m // 3)))) @ x.T, "repeated": np.diag(r.integers(0, 3, m).astype(float)),
        "graded": (q := np.linalg.qr(a)[0]) @ np.diag(10.0 ** -np.arange(m)) @ q.T, "tied rows": np.ones((m, m)) + 1e-9 * np.eye(m),
    }[kind]


@pytest.mark.parametrize("kind", ["random", "identity", "zero", "low rank", "repeated", "graded", "tied rows"])
@pytest.mark.parametrize("m", [1, 2, 3, 7, 16, 33, 64])
def test_eigen(kind, m):
    a = vectors(kind, m)
    a = (a + a.T) / 2
    values, u = w.eigen(a)
    scale = max(np.abs(a).max(), 1e-300) * m
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-13 * scale
    assert np.abs(u.T @ u - np.eye(m)).max() < 1e-12
    assert np.abs(a @ u - u * values).max() <= 1e-13 * scale


@settings(max_examples=200, deadline=None)
@given(finite, finite)
def test_no_error_is_lost(a, b):
    for op, exact in ((w.two_sum, Fraction(a) + Fraction(b)), (w.two_prod, Fraction(a) * Fraction(b))):
        high, low = op(np.array([a]), np.array([b]))
        if exact == 0 or abs(exact) > 1e-200:
            assert Fraction(float(high[0])) + Fraction(float(low[0])) == exact


def test_sums_of_outer_products_keep_106_bits():
    r = np.random.default_rng(3)
    x = np.concatenate([r.normal(size=(500, 3)) * 1e9, r.normal(size=(500, 3)), -r.normal(size=(7, 3)) * 1e-6])
    high, low = w.outer_sums(x, np.zeros_like(x))
    for k, (i, j) in enumerate(zip(*np.triu_indices(3), strict=True)):
        exact = sum(Fraction(a) * Fraction(b) for a, b in zip(x[:, i].tolist(), x[:, j].tolist(), strict=True))
        size = sum(abs(Fraction(a) * Fraction(b)) for a, b in zip(x[:, i].tolist(), x[:, j].tolist(), strict=True))
        assert abs(Fraction(float(high[k])) + Fraction(float(low[k])) - exact) <= size * Fraction(1, 2**98)


def brute(rows, most=16):
    """The contract in plain numpy and whole numbers: {(vec_id, row's place): ...}."""
    x = {i: [int(np.floor(64.0 * float(np.float32(c)))) + 1_000_000 for c in v] for i, v in rows}
    fit = [list(t) for t in sorted({tuple(v) for v in x.values()})]
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    y = np.array([[float(Fraction(n * v - s, n)) for v, s in zip(row, sums, strict=True)] for row in fit])
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    dev = {i: sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for i, row in x.items()}
    white = {i: np.array([float(Fraction(n * a - s, n)) for a, s in zip(row, sums, strict=True)]) @ u / np.sqrt(np.maximum(e, 1e-300)) for i, row in x.items()}
    return n, dev, white, e / np.trace(v)


def run(spark, rows):
    out = w.whiten(spark.createDataFrame([(i, v, "s", 1, 2, "c") for i, v in rows], SCHEMA))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return out.collect()


def test_against_brute_force(spark):
    r = np.random.default_rng(7)
    rows = [(i, (r.normal(size=20) * np.linspace(0.1, 2, 20)).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[i % 3][1]) for i in range(150)]  # a third of the rows are copies
    broken = [(5000, None), (5001, [None] + [0.0] * 19), (5002, [float("nan")] * 20), (5003, [float("inf")] + [0.0] * 19), (5004, [0.5] * 19), (5005, [])]
    got = run(spark, rows + broken)
    n, dev, white, explained = brute(rows)
    assert len(got) == 16 * len(rows) and {r.vec_id for r in got} == {i for i, _ in rows}
    sign = {r.component: np.sign(r.whitened) * np.sign(white[0][r.component - 1]) for r in got if r.vec_id == 0}
    for r in got:
        k = r.component - 1
        assert (r.n, r.deviation) == (n, dev[r.vec_id])
        assert abs(r.whitened - sign[k + 1] * white[r.vec_id][k]) < 1e-9
        assert abs(r.explained - explained[k]) <= 1e-12 and r.identity_error < 1e-12


def test_odd_tables(spark):
    assert run(spark, []) == [] and run(spark, [(1, None), (2, [])]) == []
    one = run(spark, [(1, [0.5, 0.25]), (None, [0.5, 0.25])])
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, None, 0.0, None), (2, 1, 0, None, 0.0, None)] * 2
    line = run(spark, [(i, [float(i), float(i)]) for i in range(4)])  # one direction alone varies
    assert [abs(round(r.whitened, 9)) for r in line if r.component == 1] == [round(x / 1.25**0.5, 9) for x in (1.5, 0.5, 0.5, 1.5)]
    assert {r.whitened for r in line if r.component == 2} == {None} and max(r.identity_error for r in line) < 1e-12
    huge = run(spark, [(1, [3e38]), (2, [-3e38]), (3, [1e10])])
    assert len(huge) == 3 and all(r.n == 3 for r in huge) and huge[0].deviation is None


def test_deviation_beyond_doubles():
    c = w.Centre(3, [5, -7])
    x = np.array([[1 << 29, -(1 << 29)]])
    assert c.deviation(x) == [(3 * (1 << 29) - 5) ** 2 + (3 * -(1 << 29) + 7) ** 2]
    assert c.deviation(np.array([[1 << 40, 0]])) == [None]

import math
from fractions import Fraction

import numpy as np
import pytest

from threadlake.llm import spectrum, whitening
from threadlake.llm.whitening import whiten


def symmetric(values, seed):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize("seed", range(8))
def test_inertia_counts_eigenvalues_above(seed):
    rng = np.random.default_rng(seed)
    size = int(rng.integers(1, 30))
    a = rng.normal(size=(size, size))
    a = a + a.T
    if seed % 2:
        np.fill_diagonal(a, 0)
    for shift in (-3.0, -0.1, 0.0, 0.5, 4.0):
        assert spectrum.inertia(a, shift) == (np.linalg.eigvalsh(a) > shift).sum()


@pytest.mark.parametrize(
    "values",
    [
        [5, 4, 3, 2, 1], [1e9, 1.0, 1e-3], [3, 3, 3, 1], [1] * 12, [2, 2 - 1e-12, 1, 0], [7, 0, 0], list(range(40, 0, -1)),
        [1, 1 - 1e-9, 1 - 2e-9, 1 - 3e-9, 0.5], [-5, -1, 2],
    ],
)
def test_leading_components_are_those_of_the_library(values):
    a = symmetric(values, len(values))
    got = spectrum.leading(a, 8)
    want = sorted((v for v in values if v > 1e-10), reverse=True)[:8]
    assert len(got) == len(want)
    assert np.allclose([c.value for c in got], want, rtol=0, atol=1e-13 * max(map(abs, values)) * len(values))
    q = np.array([c.vector for c in got])
    assert np.abs(q @ q.T - np.eye(len(q))).max() < 1e-13
    for c in got:
        assert np.linalg.norm(a @ c.vector - c.value * c.vector) < 1e-13 * max(map(abs, values)) * len(values)


def test_iteration_converges_within_few_steps():
    got = spectrum.leading(symmetric(list(range(64, 0, -1)), 1), 8)
    assert max(c.iterations for c in got) <= 8
    assert spectrum.leading(np.zeros((3, 3)), 8) == []
    assert spectrum.leading(np.zeros((0, 0)), 8) == []


def brute(vectors, most):
    x = np.array([[math.floor(1024 * float(c)) + 100000 for c in v] for v in vectors], object)
    n = len(x)
    sums = x.sum(axis=0)
    deviation = [sum(int(n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = np.array([[float(Fraction(int(n * a - s), n)) for a, s in zip(row, sums)] for row in x])
    v = centred.T @ centred / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:most], q[:, ::-1][:, :most]
    return n, deviation, centred @ q / np.sqrt(e), e / np.trace(v)


def test_rows_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    good = (rng.normal(size=(300, 12)) * np.linspace(0.05, 0.5, 12)).astype(np.float32)
    good[7] = good[8]
    rows = [(int(i), [float(c) for c in v], "w", 1) for i, v in enumerate(good)]
    rows[20] = (None, rows[20][1], "w", 1)
    rows[30] = (31, rows[30][1], "w", 1)
    odd = [
        (900, None, "w", 1), (901, [], "w", 1), (902, [None] * 12, "w", 1), (903, [float("nan")] + [0.0] * 11, "w", 1),
        (904, [float("inf")] + [0.0] * 11, "w", 1), (905, [1.0, 2.0], "w", 1), (906, [1e300] * 12, "w", 1),
    ]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, whitened string, n int").repartition(5)
    got = whiten(df, components=8).collect()
    n, deviation, want, explained = brute([r[1] for r in rows], 8)
    assert len(got) == len(rows) * 8 and {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    assert 0 <= got[0].identity_error < 1e-9
    signs, ids = {}, [r[0] for r in rows]
    for component in range(1, 9):
        mine = {}
        for r in got:
            if r.component == component:
                mine.setdefault(r.vec_id, []).append((r.deviation, r.whitened))
                assert math.isclose(r.explained, explained[component - 1], rel_tol=1e-10)
        column = want[:, component - 1]
        at = int(np.abs(column).argmax())
        sign = np.sign(column[at] * min(mine[ids[at]], key=lambda p: abs(abs(p[1]) - abs(column[at])))[1])
        for key in mine:
            here = sorted((deviation[i], sign * column[i]) for i, k in enumerate(ids) if k == key)
            for (d1, w1), (d2, w2) in zip(sorted(mine[key]), here):
                assert d1 == d2 and math.isclose(w1, w2, rel_tol=1e-7, abs_tol=1e-8)


def test_small_and_flat_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert whiten(spark.createDataFrame([], schema)).count() == 0
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0])], schema)).count() == 0
    assert whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], schema)).count() == 0
    two = whiten(spark.createDataFrame([(i, [float(i % 2), 1.0, 3.0 * (i % 3)]) for i in range(12)], schema)).collect()
    assert {r.component for r in two} == {1, 2} and abs(sum({round(r.explained, 12) for r in two}) - 1) < 1e-9
    assert two[0].identity_error < 1e-9
    # Zero vectors are vectors; equal variances share a space and stay orthogonal.
    equal = whiten(spark.createDataFrame([(i, [float(i & 1), float(i >> 1 & 1)]) for i in range(8)], schema)).collect()
    assert len(equal) == 16 and equal[0].identity_error < 1e-9


def test_large_entries_are_summed_exactly(spark):
    big = 4_000_000_000.0
    df = spark.createDataFrame([(i, [big * (i % 3), -big * i, 1.0 * i]) for i in range(9)], "vec_id long, embedding array<double>")
    got = whiten(df, components=3).collect()
    n, deviation, _, explained = brute([[big * (i % 3), -big * i, 1.0 * i] for i in range(9)], 3)
    assert {r.component for r in got} == {1, 2}
    assert {r.deviation for r in got} == {d if d < 1 << 63 else None for d in deviation}
    rows = np.array([[1 << 40, 3], [-5, 1 << 33], [7, 9]], np.int64)
    assert (whitening._wide_products(rows) == rows.astype(object).T @ rows.astype(object)).all()
    many = np.random.default_rng(1).integers(-(1 << 28), 1 << 28, size=(300, 3))
    assert (whitening._wide_products(many) == many.astype(object).T @ many.astype(object)).all()
    assert (whitening._wide_sums(many) == many.astype(object).sum(axis=0)).all()

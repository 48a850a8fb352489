import math
from fractions import Fraction

import numpy as np
import pytest

from tokenloom.llm import whitening as w


def brute(vectors, components=8):
    """Exact sums in Python integers, and the covariance decomposed by another routine."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    dev = [sum((n * r[j] - s[j]) ** 2 for j in range(d)) for r in x]
    off = np.array([[float(Fraction(n * r[j] - s[j], n)) for j in range(d)] for r in x])
    v = off.T @ off / n
    values, u = np.linalg.eigh(v)
    values, u = values[::-1][:components], u[:, ::-1][:, :components]
    return n, dev, off @ u / np.sqrt(values), values / np.trace(v)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, id string, label int")


def test_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(300, 12)) * np.geomspace(1, 0.1, 12)).astype(np.float32)
    vectors[7] = vectors[8]
    rows = [(i, [float(c) for c in v], "clash", 1) for i, v in enumerate(vectors)]
    bad = [(900, None, "", 0), (901, [None] * 12, "", 0), (902, [math.nan] * 12, "", 0), (903, [math.inf] + [0.0] * 11, "", 0), (904, [], "", 0), (905, [1.0], "", 0)]
    got = w.whiten(frame(spark, rows + bad).repartition(5)).collect()
    n, dev, white, explained = brute(vectors)
    assert len(got) == 300 * 8 and {r.n for r in got} == {n}
    made = np.zeros((300, 8))
    for r in got:
        assert int(r.deviation) == dev[r.vec_id]
        assert abs(r.explained - explained[r.component - 1]) < 1e-12
        assert r.identity_error < 1e-9
        made[r.vec_id, r.component - 1] = r.whitened
    assert np.abs(np.abs(made) - np.abs(white)).max() < 1e-8
    assert np.abs(made.T @ made / n - np.eye(8)).max() < 1e-9


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 3, [None, []]])
def test_nothing_to_whiten(spark, vectors):
    assert w.whiten(frame(spark, [(i, v, "", 0) for i, v in enumerate(vectors)])).count() == 0


def test_null_and_repeated_ids_and_few_dimensions(spark):
    rows = [(None, [1.0, 0.0], "", 0), (1, [0.0, 1.0], "", 0), (1, [0.0, 1.0], "", 0), (2, [-1.0, 0.5], "", 0)]
    got = w.whiten(frame(spark, rows)).collect()
    assert len(got) == 8 and sorted({r.component for r in got}) == [1, 2]
    assert sum(r.vec_id is None for r in got) == 2


def test_large_components_stay_exact(spark):
    rows = [(i, [float(c), 1.0], "", 0) for i, c in enumerate((1e12, -1e12, 3.5, 7e11))]
    got = {r.vec_id: int(r.deviation) for r in w.whiten(frame(spark, rows)).collect() if r.component == 1}
    vectors = np.array([r[1] for r in rows], np.float32)
    assert got == dict(enumerate(brute(vectors, 1)[1]))


def test_inertia_counts_signs():
    rng = np.random.default_rng(5)
    for _ in range(100):
        n = rng.integers(1, 9)
        a = rng.integers(-2, 3, size=(n, n)).astype(float)
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        assert w.inertia(a) == ((values > 1e-9).sum(), (values < -1e-9).sum())


@pytest.mark.parametrize("values", [[5] * 10 + [1, 1], [3, 3, 2, 2, 1, 1, 0, 0, 0], [1e-30, 1e-31, 0], [4], [9, 7, 7 - 1e-8, 5, 4, 4 - 1e-13, 3, 2, 1]])
def test_components_of_equal_and_close_values(values):
    q, _ = np.linalg.qr(np.random.default_rng(2).normal(size=(len(values), len(values))))
    v = q @ np.diag(np.array(values, float)) @ q.T
    v = (v + v.T) / 2
    found, u = w.leading(v, 8)
    want = np.sort(values)[::-1][:8]
    assert np.abs(found - want).max() <= 1e-13 * max(values)
    assert np.abs(v @ u - u * found).max() <= 1e-13 * max(values)
    assert np.abs(u.T @ u - np.eye(len(found))).max() < 1e-12


def test_sums_of_wide_numbers():
    y = np.random.default_rng(1).integers(-(2**45), 2**45, size=(50, 3))
    whole = y.astype(object)
    assert (w.exact_gram(y) == whole.T @ whole).all()

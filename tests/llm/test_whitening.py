"""Whitening against exact arithmetic and NumPy on the whole table."""

from fractions import Fraction

import numpy as np

from quillspark.llm import whitening as wh
from quillspark.llm.whitening import Moments, whitened


def random_rows(n, dim, seed):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(dim, dim)) * np.linspace(0.2, 2, dim)
    return (rng.normal(size=(n, dim)) @ mix).astype(np.float32)


def plain(x, k):
    """Covariance in exact fractions of the distinct vectors, then NumPy."""
    fit = np.array(sorted({tuple(r) for r in x.tolist()}), dtype=object)
    n, dim = fit.shape
    s = [sum(c) for c in fit.T]
    away = [[n * a - t for a, t in zip(row, s)] for row in fit.tolist()]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in away), n**3)) for j in range(dim)] for i in range(dim)])
    e, u = np.linalg.eigh(v)
    return n, s, e[::-1][:k], u[:, ::-1][:, :k], np.trace(v)


def test_like_exact_arithmetic(spark, monkeypatch):
    monkeypatch.setattr(wh, "BLOCK", 16)
    x = random_rows(150, 7, 1)
    rows = [(k, v.tolist(), 1) for k, v in enumerate(x)]
    rows += [(200 + k, x[k].tolist(), 1) for k in range(30)] + [(7, x[9].tolist(), 1), (None, x[3].tolist(), 1)]
    odd = [(300, None, 1), (301, [1.0] * 6 + [None], 1), (302, [float("nan")] + [0.0] * 6, 1), (303, [float("inf")] * 7, 1), (304, [], 1), (305, [1.0, 2.0], 1), (306, [3e38] * 7, 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, component int").repartition(5)
    got = whitened(df, components=4).collect()
    assert len(got) == len(rows) * 4
    ints = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in r[1]] for r in rows], dtype=object)
    n, s, e, u, trace = plain(ints, 4)
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    for (i, *_), z in zip(rows, ints):
        deviation = sum((n * a - t) ** 2 for a, t in zip(z, s))
        mine = by[(i, deviation)]
        y = np.array([float(Fraction(int(n * a - t), n)) for a, t in zip(z, s)]) @ u / np.sqrt(e)
        for c in range(4):
            r = mine[c + 1]
            assert r.n == n and abs(abs(r.whitened) - abs(y[c])) < 1e-9 and abs(r.explained / (e[c] / trace) - 1) < 1e-9 and r.identity_error < 1e-9
    signs = {(r.component, np.sign(r.whitened * v)) for r in got if r.vec_id == 0 for v in [(np.array([float(Fraction(int(n * a - t), n)) for a, t in zip(ints[0], s)]) @ u)[r.component - 1]]}
    for r in got:  # one sign per component, for all rows
        if r.vec_id is not None and 0 < r.vec_id < 150 and r.vec_id != 7:
            v = (np.array([float(Fraction(int(n * a - t), n)) for a, t in zip(ints[r.vec_id], s)]) @ u)[r.component - 1]
            assert abs(v) < 1e-9 or (r.component, np.sign(r.whitened * v)) in signs


def test_merging_is_exact_far_from_zero():
    rng = np.random.default_rng(2)
    x = rng.integers(-50, 50, size=(400, 5)) + 10**12
    parts = [Moments.of(x[k : k + 37]) for k in range(0, 400, 37)]
    while len(parts) > 1:
        parts = [a.merged(b) for a, b in zip(parts[::2], parts[1::2])] + parts[len(parts) // 2 * 2 :]
    away = x - 10**12
    assert parts[0].total == x.sum(axis=0).tolist() and np.allclose(parts[0].scatter, 400 * np.cov(away.T, bias=True), rtol=1e-12)


def test_no_variance_and_no_rows(spark):
    shape = "vec_id long, embedding array<float>"
    got = whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], shape)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got] == [(1, 0, None, None, None)] * 4
    flat = whitened(spark.createDataFrame([(k, [float(k), 2.0]) for k in range(5)], shape)).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in flat) and all(r.identity_error < 1e-9 for r in flat)
    assert whitened(spark.createDataFrame([(1, None)], shape)).collect() == []


def test_a_deviation_beyond_a_long_is_null():
    fit = wh.Whitener(10, [0], np.eye(1), np.ones(1), 1.0)
    assert fit.deviations(np.array([[3], [1 << 40]])) == [900, None]

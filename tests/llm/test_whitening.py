"""Embedding whitening against plain numpy over Fractions."""

import math
from collections import defaultdict
from fractions import Fraction

import numpy as np

from cargoline.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, x string, d int, n long"


def made(seed, n, d):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(d, d))
    return [[float(np.float32(v)) for v in row] for row in rng.normal(size=(n, d)) @ mix]


def brute(vectors, most=16):
    xs = [[math.floor(64 * Fraction(c)) + 1000000 for c in v] for v in vectors]
    fit = sorted({tuple(x) for x in xs})
    n, d = len(fit), len(fit[0])
    s = [sum(x[i] for x in fit) for i in range(d)]
    v = np.array([[float(sum((n * x[i] - s[i]) * (n * x[j] - s[j]) for x in fit) / Fraction(n**3)) for j in range(d)] for i in range(d)])
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1], axes[:, ::-1]
    out = []
    for x in xs:
        dev = sum((n * a - b) ** 2 for a, b in zip(x, s))
        centred = np.array([float(Fraction(n * a - b, n)) for a, b in zip(x, s)])
        out.append((n, dev, centred @ axes[:, :most] / np.sqrt(e[:most]), e[:most] / e.sum()))
    return out


def test_equals_brute_force_and_drops_bad_vectors(spark):
    good = made(1, 300, 20)
    good += [good[0], good[0], [c + 1e-4 for c in good[5]]]
    bad = [None, [], [None] * 20, [1.0, float("nan")] * 10, [float("inf")] * 20, [1.0, None] * 10, [3e38] * 20]
    data = [(i, v, "a", 1, 2) for i, v in enumerate(good)] + [(1000 + i, v, None, None, None) for i, v in enumerate(bad)]
    got = defaultdict(dict)
    rows = whitening.whiten(spark.createDataFrame(data, SCHEMA).repartition(5)).collect()
    assert rows[0].__fields__ == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for r in rows:
        got[r.vec_id][r.component] = r
    single = [[float(np.float32(c)) for c in v] for v in good]
    want = brute(single)
    assert set(got) == set(range(len(good))) and len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9
    signs = np.sign([got[0][k].whitened * want[0][2][k - 1] for k in range(1, 17)])
    for i, (n, dev, w, e) in enumerate(want):
        assert sorted(got[i]) == list(range(1, 17))
        assert {(r.n, int(r.deviation)) for r in got[i].values()} == {(n, dev)}
        np.testing.assert_allclose([got[i][k].whitened for k in range(1, 17)], w * signs, atol=1e-8)
        np.testing.assert_allclose([got[i][k].explained for k in range(1, 17)], e, rtol=1e-9)


def test_large_values_stay_exact(spark):
    vectors = [[1e9, 2.0, -5e8], [-1e9, 7.5, 3.0], [12.0, -3.25, 4e8], [5.0, 1.0, 0.0], [9e8, 0.5, 1.0]]
    data = [(i, v, None, None, None) for i, v in enumerate(vectors)]
    got = {r.vec_id: int(r.deviation) for r in whitening.whiten(spark.createDataFrame(data, SCHEMA)).collect()}
    assert got == {i: w[1] for i, w in enumerate(brute([[float(np.float32(c)) for c in v] for v in vectors]))}
    assert max(got.values()) > 2**63


def test_lengths_ranks_and_empty_tables(spark):
    data = [(None, [1.0, 2.0], "a", 1, 2), (1, [1.0, 2.0], "a", 1, 2), (2, [3.0, 5.0], "a", 1, 2), (3, [4.0], "a", 1, 2), (4, [9.0], "a", 1, 2), (5, [1.0, 1.0, 1.0], "a", 1, 2)]
    rows = whitening.whiten(spark.createDataFrame(data, SCHEMA)).collect()
    # two distinct vectors span one direction; a lone vector none
    assert sorted((r.vec_id or -1, r.component, r.n) for r in rows) == [(-1, 1, 2), (1, 1, 2), (2, 1, 2), (3, 1, 2), (4, 1, 2)]
    assert all(abs(abs(r.whitened) - 1) < 1e-9 and abs(r.explained - 1) < 1e-9 for r in rows)
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, "a", 1, 2)], SCHEMA)).count() == 0


def test_polarisation_equals_products():
    rng = np.random.default_rng(3)
    x = rng.integers(-1000, 1000, (200, 7))
    squares = whitening.add_squares(np.zeros(28, dtype=object), x)
    v = whitening.covariance(200, x.sum(axis=0), squares)
    np.testing.assert_allclose(v, np.cov(x.T, bias=True), rtol=1e-12, atol=1e-9)
    big = whitening.add_squares(np.zeros(28, dtype=object), x * 2**40)
    assert [int(a) for a in big] == [int(a) * 2**80 for a in squares]

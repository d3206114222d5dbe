"""Whitening against numpy's eigenvectors, exact integers against plain Python."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from marginalia.llm import whitening


def plain(vectors):
    """n, deviations by place, whitened vectors, shares of the trace, from plain arithmetic."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    z = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(row, sums)] for row in x])
    e, axes = np.linalg.eigh(z.T @ z / n)
    e, axes = e[::-1][:8], axes[:, ::-1][:, :8]
    return n, deviation, z @ axes / np.sqrt(e), e / np.trace(z.T @ z / n)


def test_against_numpy(spark):
    r = random.Random(3)
    rows = [(i, None if i % 9 == 0 else [] if i % 11 == 0 else [
        r.gauss(0, 1 + j) if (i + j) % 31 else (None, float("nan"), float("inf"))[i % 3] for j in range(12)], 1.5) for i in range(400)]
    rows += [(i, [r.gauss(0, 1)] * 5, 0.0) for i in range(400, 410)]  # vectors of another length
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, whitened double")
    kept = [(x["vec_id"], x["embedding"]) for x in df.collect()
            if x["embedding"] and len(x["embedding"]) == 12 and all(c is not None and math.isfinite(c) for c in x["embedding"])]
    n, deviation, white, share = plain([v for _, v in kept])
    place = {i: k for k, (i, _) in enumerate(kept)}
    got = whitening.whiten(df).collect()
    assert len(got) == 8 * len(kept)
    found = np.zeros((n, 8))
    for x in got:
        k = place[x["vec_id"]]
        assert x["n"] == n and x["deviation"] == deviation[k] and x["identity_error"] < 1e-9
        assert abs(x["explained"] / share[x["component"] - 1] - 1) < 1e-9
        found[k, x["component"] - 1] = x["whitened"]
    for c in range(8):
        assert min(np.abs(found[:, c] - white[:, c]).max(), np.abs(found[:, c] + white[:, c]).max()) < 1e-8


def test_equal_eigenvalues_and_nothing(spark):
    rows = [(k, [0.5 * (j == i) * s for j in range(6)]) for k, (i, s) in enumerate((i, s) for i in range(4) for s in (1, -1))]
    schema = "vec_id long, embedding array<double>"
    got = whitening.whiten(spark.createDataFrame(rows, schema)).collect()
    assert sorted({x["component"] for x in got}) == [1, 2, 3, 4]  # no component of eigenvalue zero
    assert all(abs(x["explained"] - 0.25) < 1e-12 and x["identity_error"] < 1e-12 for x in got)
    for none in ([], rows[:1], rows[:1] * 5, [(1, None), (2, [])]):
        assert whitening.whiten(spark.createDataFrame(none, schema)).count() == 0
    repeated = whitening.whiten(spark.createDataFrame(rows * 3, schema))
    assert repeated.count() == 3 * 8 * 4


@pytest.mark.parametrize("d", [1, 2, 5, 9])
def test_polynomial(spark, d):
    """Roots and coefficients of an integer matrix; singular and diagonal ones too."""
    r = random.Random(d)
    for rank in {1, d}:
        f = [[r.randrange(-50, 50) for _ in range(d)] for _ in range(rank)]
        m = [[sum(row[i] * row[j] for row in f) for j in range(d)] for i in range(d)]
        poly = whitening.characteristic_polynomial(spark.range(1), m)
        assert poly[d] == 1 and poly[d - 1] == -sum(m[i][i] for i in range(d))
        roots = np.sort(np.linalg.eigvalsh(np.array(m, float)))[::-1]
        positive = whitening.roots_above(poly, 0, 0)
        assert positive == sum(roots > 1e-6)
        for k in range(1, positive + 1):
            num, bits = whitening.isolate(poly, k)
            assert abs(num / 2 ** bits / roots[k - 1] - 1) < 1e-6

"""Whitening against the eigenvectors of the exact covariance."""

import collections
import math

import numpy as np
import pytest

from tallgrass.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label string, kind int, rows long, width int, sums string"


def frame(spark, vectors):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], "a", 1, 2, 3, "b") for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def check(got, vectors, components):
    """Every row of the result, up to the sign of each component."""
    used = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in vectors]
    n, x = len(used), np.array([v for _, v in used], dtype=object)
    sums = x.sum(axis=0)
    centred = (n * x - sums).astype(np.float64) / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    k = min(components, int((values > 1e-12 * values[0]).sum()))
    want = centred @ basis[:, :k] / np.sqrt(values[:k])
    deviations = [d if d < 1 << 63 else None for d in (int(((n * v - sums) ** 2).sum()) for v in x)]
    rows = got.collect()
    assert len(rows) == n * k
    by_place = collections.defaultdict(list)
    for r in rows:
        by_place[r.vec_id, r.deviation, r.component].append(r.whitened)
    table = np.array([[by_place[i, d, c].pop() for c in range(1, k + 1)] for (i, _), d in zip(used, deviations, strict=True)])
    assert not any(by_place.values())
    sign = np.sign((table * want).sum(axis=0))
    assert np.allclose(table, want * sign, rtol=1e-7, atol=1e-7)
    assert {r.n for r in rows} == {n}
    assert all(math.isclose(r.explained, values[r.component - 1] / values.sum(), rel_tol=1e-9) for r in rows)
    errors = {r.identity_error for r in rows}
    assert len(errors) == 1 and errors.pop() < 1e-9


@pytest.mark.parametrize(("width", "components"), [(64, 32), (7, 32), (90, 8), (1, 4)])
def test_whitening(spark, width, components):
    random = np.random.default_rng(width)
    data = random.standard_normal((400, width)) * np.linspace(3, 0.2, width)
    vectors = [(i, v) for i, v in enumerate(data)] + [(0, data[0]), (None, data[1]), (None, data[1])]
    broken = [(500, None), (501, []), (502, [None] * width), (503, [float("nan")] + [0.0] * (width - 1)), (504, [float("inf")] * width), (505, [0.5] * (width + 1))]
    got = whitening.whiten(spark, frame(spark, vectors + broken), components)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(got, vectors, components)


def test_directions_without_variance_are_no_components(spark):
    random = np.random.default_rng(3)
    data = random.standard_normal((200, 3)) @ np.eye(3, 10)
    check(whitening.whiten(spark, frame(spark, list(enumerate(data)))), list(enumerate(data)), 32)
    for vectors in ([], [(1, None)], [(1, [0.5, 0.25])], [(i, [0.5, 0.25]) for i in range(9)]):
        assert whitening.whiten(spark, frame(spark, vectors)).count() == 0


def test_large_entries_keep_exact_deviations(spark):
    vectors = [(i, [1000.0 * i, -3000.0, 65536.0 * (i % 3)]) for i in range(300)]
    check(whitening.whiten(spark, frame(spark, vectors)), vectors, 32)
    huge = whitening.whiten(spark, frame(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 2.0])]))
    assert {r.deviation for r in huge.collect()} == {None, (3 * (whitening.quantise(np.array([2.0]))[0]) - 192) ** 2}


@pytest.mark.parametrize("values", [[5.0] * 6 + [1.0] * 10, [9.0, 9.0, 4.0, 4.0, 4.0, *np.linspace(3, 0.01, 60)], list(np.geomspace(1e4, 1e-3, 40)), [3.0, 2.0, 0.0, 0.0]])
def test_repeated_and_spread_singular_values(values):
    random = np.random.default_rng(9)
    width = len(values)
    left, _ = np.linalg.qr(random.standard_normal((width * 3, width)))
    turned, _ = np.linalg.qr(random.standard_normal((width, width)))
    x = left * np.array(values) @ turned.T

    def product(v):
        p = x @ v
        return p @ x, float(p @ p)

    found, basis = whitening.bidiagonalise(product, width, 8)
    want = sorted([v for v in values if v > 0], reverse=True)[:8]
    assert np.allclose(found, want, rtol=1e-9)
    assert np.allclose(basis.T @ basis, np.eye(len(want)), atol=1e-12)
    assert np.allclose(x.T @ (x @ basis), basis * found**2, atol=1e-9 * found[0] ** 2)

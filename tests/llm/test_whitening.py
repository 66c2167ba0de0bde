"""Operator 13 against a plain computation."""

from __future__ import annotations

import numpy as np
import pytest

from sojourn.llm import whitening


def symmetric(kind: str, n: int) -> np.ndarray:
    rng = np.random.default_rng(n)
    a = rng.normal(size=(n, n))
    if kind == "plain":
        return a @ a.T
    if kind == "identity":
        return np.eye(n)
    if kind == "zero":
        return np.zeros((n, n))
    if kind == "two clusters":
        q, _ = np.linalg.qr(a)
        a = q @ np.diag([5.0] * (n // 2) + [1.0] * (n - n // 2)) @ q.T
        return (a + a.T) / 2
    if kind == "low rank":
        a = a[:, : max(1, n // 3)]
        return a @ a.T
    a = a * 10.0 ** -np.arange(n).clip(0, 8)
    return a @ a.T


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 64, 130])
@pytest.mark.parametrize("kind", ["plain", "identity", "zero", "two clusters", "low rank", "graded"])
def test_leading_components(kind, n):
    a = symmetric(kind, n)
    values, vectors = whitening.leading_components(a, 16)
    size = max(np.abs(a).max(), 1e-300)
    assert len(values) == min(16, n)
    assert np.abs(values - np.sort(np.linalg.eigvalsh(a))[::-1][:16]).max() < 1e-13 * n * size
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-12
    assert np.abs(a @ vectors.T - vectors.T * values).max() < 1e-12 * size


ROWS = "vec_id long, embedding array<float>, n long, whitened string"


def rows_of(vectors):
    return [(i, v if v is None else [None if x is None else float(x) for x in v], 5, "x") for i, v in enumerate(vectors)]


def plainly(rows, count=16):
    sound = [(i, v) for i, v, *_ in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in sound], object)
    fit = sorted({tuple(r) for r in x.tolist()})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(n * c - s) / n for c, s in zip(r, sums)] for r in fit])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:count], vectors.T[::-1][:count]
    out = {}
    for (i, _), r in zip(sound, x.tolist()):
        deviation = sum((n * c - s) ** 2 for c, s in zip(r, sums))
        y = np.array([float(n * c - s) / n for c, s in zip(r, sums)])
        out.setdefault(i, []).append((deviation, vectors @ y / np.sqrt(np.maximum(values, 1e-300))))
    return n, values / np.trace(covariance), out


def test_against_a_plain_computation(spark):
    rng = np.random.default_rng(3)
    vectors = list((rng.normal(size=(300, 20)) * np.linspace(0.3, 3, 20)).astype(np.float32))
    vectors += [vectors[0]] * 120 + [vectors[1], None, [None] * 20, [float("nan")] * 20, [float("inf")] + [0.0] * 19, [1.0, 2.0], []]
    rows = [*rows_of(vectors), (None, [0.5] * 20, None, None)]
    df = spark.createDataFrame(rows, ROWS).repartition(7)
    got = whitening.whiten(df).collect()
    kept = [r for r in rows if r[1] is None or len(r[1]) == 20]
    n, explained, expected = plainly(kept)
    assert len(got) == 16 * sum(len(v) for v in expected.values()) and {r["n"] for r in got} == {n} == {301}
    assert got[0].__fields__ == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    signs = {}
    for r in got:
        deviation, white = expected[r["vec_id"]][0]
        assert r["deviation"] == deviation
        value = white[r["component"] - 1]
        assert abs(abs(r["whitened"]) - abs(value)) < 1e-9
        if abs(value) > 1e-6:
            assert signs.setdefault(r["component"], np.sign(value * r["whitened"])) == np.sign(value * r["whitened"])
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9
    errors = {r["identity_error"] for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-9


def test_fewer_components_than_wanted(spark):
    one = spark.createDataFrame(rows_of([[1.0, 2.0, 3.0]] * 9), ROWS)
    assert whitening.whiten(one).count() == 0
    three = spark.createDataFrame(rows_of([[0.0, 0.0, 0.0], [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]]), ROWS)
    got = whitening.whiten(three).collect()
    assert {r["component"] for r in got} == {1, 2} and all(r["identity_error"] < 1e-9 for r in got)
    assert whitening.whiten(three.limit(0)).count() == 0
    assert whitening.whiten(spark.createDataFrame(rows_of([None, []]), ROWS)).count() == 0


def test_entries_that_no_long_holds(spark):
    rows = rows_of([[1e30, 0.0], [-1e30, 1.0], [0.0, 2.0], [1.0, 5.0]])
    got = whitening.whiten(spark.createDataFrame(rows, ROWS)).collect()
    assert got and all(r["deviation"] is None for r in got if r["vec_id"] < 2)

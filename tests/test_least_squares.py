"""Least squares by triangles of tasks against numpy over all rows."""

import numpy as np
import pytest

from weftline.operators import least_squares


def rows_of(seed, n):
    rng = np.random.default_rng(seed)
    x = rng.uniform(-3, 40, n)
    y = np.polyval([0.002, -0.1, 1.0, 4.0], x) + rng.normal(size=n)
    return [(int(k), float(a), float(b)) for k, a, b in zip(rng.integers(0, 3, n), x, y, strict=True)]


def test_each_key_and_all(spark):
    rows = rows_of(1, 500)
    df = spark.createDataFrame(rows, "key int, x double, y double").repartition(6)
    for r in least_squares.fit_by_key(df, 3).collect():
        x, y = np.array([t[1:] for t in rows if t[0] == r.key]).T
        assert r.n == len(x) and r.coefficients == pytest.approx(np.polyfit(x, y, 3)[::-1], rel=1e-7)
        assert r.sse == pytest.approx(((np.polyval(r.coefficients[::-1], x) - y) ** 2).sum(), rel=1e-8)
    x, y = np.array([t[1:] for t in rows]).T
    assert least_squares.fit(df, 2).first().coefficients == pytest.approx(np.polyfit(x, y, 2)[::-1], rel=1e-8)


def test_high_degree_stays_accurate(spark):
    """Degree 8 on 0 to 1,000, where sums of powers up to 16 lose all digits."""
    x = np.linspace(0, 1000, 400)
    y = np.cos(x / 200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double").repartition(5)
    found = least_squares.fit(df, 8).first()
    best = np.polynomial.Legendre.fit(x, y, 8)
    assert np.abs(np.polyval(found.coefficients[::-1], x) - best(x)).max() < 1e-6


def test_golden_and_edge_cases(spark, monkeypatch):
    rows = [(k, float(x), 0.2 * x * x + 0.2 * x + 0.2) for k in ("a", None) for x in range(10)]
    rows += [("a", None, 1.0), ("a", 1.0, float("nan")), ("a", float("inf"), 1.0), ("b", None, None), ("c", 2.0, 5.0)]
    df = spark.createDataFrame(rows, "key string, x double, y double").withColumnRenamed("key", "key")
    monkeypatch.setattr(least_squares, "KEYS_HELD", 1)
    found = {r.key: r for r in least_squares.fit_by_key(df, 2).collect()}
    assert set(found) == {"a", None, "c"} and found["a"].n == 10
    for key in ("a", None):
        assert found[key].coefficients == pytest.approx([0.2, 0.2, 0.2]) and found[key].sse == pytest.approx(0, abs=1e-18)
    assert np.polyval(found["c"].coefficients[::-1], 2.0) == pytest.approx(5.0)
    assert least_squares.fit(df.limit(0), 2).collect() == []

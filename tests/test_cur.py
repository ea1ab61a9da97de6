"""CUR against numpy over the whole matrix."""

import math

import numpy as np
import pytest

from weftline.operators import cur as c

SCHEMA = "r bigint, c bigint, v double"

# Ratings of seven people for five films.
GOLDEN = np.array(
    [[1, 1, 1, 0, 0], [3, 3, 3, 0, 0], [4, 4, 4, 0, 0], [5, 5, 5, 0, 0], [0, 0, 0, 4, 4], [0, 0, 0, 5, 5], [0, 0, 0, 2, 2]],
    dtype=float,
)


def entries_of(spark, a, zeros=True):
    cells = [(int(r), int(k), float(a[r, k])) for r in range(a.shape[0]) for k in range(a.shape[1]) if zeros or a[r, k]]
    return spark.createDataFrame(cells, SCHEMA).repartition(5)


def plain(a, found):
    left, right = a[:, found.columns], a[found.rows]
    link = np.linalg.pinv(left, rcond=1e-10) @ a @ np.linalg.pinv(right, rcond=1e-10)
    return link, np.linalg.norm(a - left @ link @ right) / np.linalg.norm(a)


@pytest.mark.parametrize("zeros", [True, False])
@pytest.mark.parametrize("rows, columns", [(2, 2), (4, 3), (20, 20)])
def test_golden(spark, zeros, rows, columns):
    """Of rank 2, so larger draws have dependent rows and columns."""
    df = entries_of(spark, GOLDEN, zeros)
    found = c.cur(df, rows, columns, seed=3)
    assert len(set(found.rows)) == min(rows, 7) and len(set(found.columns)) == min(columns, 5)
    link, error = plain(GOLDEN, found)
    assert found.link == pytest.approx(link, abs=1e-10) and found.error == pytest.approx(error, abs=1e-7)
    assert found.norm == pytest.approx(np.linalg.norm(GOLDEN))
    left, right = GOLDEN[:, found.columns], GOLDEN[found.rows]
    for row in c.approximated(df, found).collect():
        assert row.approx == pytest.approx((left @ link @ right)[row.r, row.c], abs=1e-9)


def test_of_full_rank(spark):
    rng = np.random.default_rng(5)
    a = rng.normal(size=(200, 30)) * rng.uniform(0.1, 4, size=(200, 1))
    found = c.cur(entries_of(spark, a), 12, 9, seed=1)
    link, error = plain(a, found)
    assert found.link == pytest.approx(link, rel=1e-8, abs=1e-12) and found.error == pytest.approx(error, rel=1e-9)


def test_draws_follow_squared_norms(spark):
    """Over many seeds the first row drawn is each row as often as its share of the squared norm."""
    a = np.array([[3.0, 0], [0, 2], [1, 1], [0, 0]])
    df = entries_of(spark, a).cache()
    shares = np.array([9, 4, 2, 0]) / 15
    runs = 150
    first = [c.drawn(df, "r", 1, seed) for seed in range(runs)]
    every = first[0]
    for one in first[1:]:
        every = every.unionAll(one)
    seen = np.bincount([r["id"] for r in every.collect()], minlength=4) / runs
    assert np.abs(seen - shares).max() < 4 * math.sqrt(0.25 / runs) and seen[3] == 0


def test_edge_cases(spark):
    empty = c.cur(spark.createDataFrame([], SCHEMA), 2, 2, 1)
    assert empty.rows == [] and empty.link.size == 0 and empty.error == 0
    assert c.link_table(spark, empty).count() == 0
    nothing = c.cur(spark.createDataFrame([(1, 1, 0.0), (None, 1, 2.0), (1, None, 2.0), (1, 2, None)], SCHEMA), 2, 2, 1)
    assert nothing.rows == []
    single = c.cur(spark.createDataFrame([(7, 9, -2.0), (None, 1, 5.0)], SCHEMA), 2, 2, 1)
    assert (single.rows, single.columns, single.error) == ([7], [9], 0) and single.link == pytest.approx(np.array([[-0.5]]))
    with pytest.raises(ValueError, match="finite"):
        c.cur(spark.createDataFrame([(1, 1, float("nan"))], SCHEMA), 1, 1, 1)

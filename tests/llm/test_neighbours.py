"""Approximate neighbours against comparing every query with every vector."""

import numpy as np
import pytest

from weftline.llm import neighbours as nb

SCHEMA = "vec_id bigint, embedding array<float>"
ASKED = "vec_id % 20 = 0"


def usable(v, length):
    return v is not None and len(v) == length and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, k=20, length=None):
    length = length or max(len(v) for _, v in rows if v)
    kept = [(i, np.array(v, "f8")) for i, v in rows if i is not None and usable(v, length)]
    ids, v = np.array([i for i, _ in kept]), np.stack([v for _, v in kept])
    out = {}
    for q in sorted({i for i in ids.tolist() if i % 20 == 0}):
        best = {}
        for own in v[ids == q]:
            for i, s in zip(ids.tolist(), nb.exact_scores(own[None, :], v).tolist(), strict=True):
                if i != q:
                    best[i] = max(best.get(i, -np.inf), s)
        out[q] = [(i, s) for s, i in sorted(((-s, i) for i, s in best.items()))[:k]]
        out[q] = [(i, -s) for i, s in out[q]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, expected):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in e}) for q, e in expected.items())
    return hits / sum(map(len, expected.values()))


def scores_hold(got, rows):
    of = {i: np.array(v, "f8") for i, v in rows if v is not None and None not in v}
    for q, mine in got.items():
        assert mine == sorted(mine, key=lambda x: (-x[1], x[0])) and len({i for i, _ in mine}) == len(mine)
        for i, s in mine:
            assert i != q and s == pytest.approx(float(of[q] @ of[i]), rel=1e-12)


def random_rows(n, d, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, d))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v *= np.exp(rng.uniform(0, np.log(spread), (n, 1))) if spread > 1 else 1
    return [(i, [float(np.float32(x)) for x in row]) for i, row in enumerate(v)]


def test_hadamard():
    for d in (1, 2, 8, 32, 64, 128):
        h = nb.hadamard(np.eye(d))
        assert np.allclose(h @ h.T, np.eye(d)) and np.allclose(np.abs(h), d**-0.5)


def test_whole_small_table_is_exact(spark):
    rows = random_rows(300, 64, 1)
    got = found(nb.nearest(spark.createDataFrame(rows, SCHEMA), ASKED))
    assert {q: [i for i, _ in e] for q, e in got.items()} == {q: [i for i, _ in e] for q, e in brute(rows).items()}
    scores_hold(got, rows)


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    rows = [tuple(r) for r in df.collect()]
    got, expected = found(nb.nearest(df, ASKED)), brute(rows)
    assert recall(got, expected) >= 0.93 and all(len(e) == 20 for e in got.values()) and len(got) == 100
    scores_hold(got, rows)


@pytest.mark.parametrize("spread", [1.0, 8.0])
def test_few_probes_and_split_buckets(spark, spread):
    """A tight group, and buckets small enough to be hashed again; products, not angles."""
    rows = random_rows(3000, 24, 2, spread)
    rng = np.random.default_rng(3)
    centre = rng.normal(size=24)
    centre /= np.linalg.norm(centre)
    tight = [(3000 + i, [float(np.float32(x)) for x in centre + 0.02 * rng.normal(size=24)]) for i in range(1500)]
    rows += tight
    df = spark.createDataFrame(rows, SCHEMA)
    got = found(nb.nearest(df, ASKED, probe_rows=100, split_rows=300))
    assert recall(got, brute(rows)) >= 0.9
    scores_hold(got, rows)


def test_copies_ties_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(nb, "BLOCK_ITEMS", 16)
    monkeypatch.setattr(nb, "BLOCK_QUERIES", 8)
    rows = random_rows(200, 5, 4)
    rows += [(1000 + i, rows[7][1]) for i in range(400)] + rows[:50]
    got, expected = found(nb.nearest(spark.createDataFrame(rows, SCHEMA).repartition(4), ASKED, k=5)), brute(rows, 5)
    assert {q: [i for i, _ in e] for q, e in got.items()} == {q: [i for i, _ in e] for q, e in expected.items()}


def test_edge_cases(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert nb.nearest(empty, ASKED).collect() == []
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0, 2.0]),
        (1, None),
        (2, []),
        (3, [0.0, -0.0, 0.0]),
        (4, [1.0, None, 1.0]),
        (5, [nan, 1.0, 1.0]),
        (6, [inf, 1.0, 1.0]),
        (7, [1.0, 1.0]),
        (None, [1.0, 1.0, 1.0]),
        (8, [-1.0, 0.5, 0.0]),
        (20, [3.0, 0.0, 0.0]),
        (20, [0.0, 0.0, 1.0]),
        (9, [0.0, -2.0, 0.0]),
    ]
    got, expected = found(nb.nearest(spark.createDataFrame(rows, SCHEMA), ASKED)), brute(rows, length=3)
    assert got == expected and got[0][0] == (20, 3.0)
    assert found(nb.nearest(spark.createDataFrame(rows[:1], SCHEMA), ASKED)) == {}
    extra = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", cell int, v int")
    assert found(nb.nearest(extra, ASKED)) == expected
    doubles = spark.createDataFrame(rows, "vec_id int, embedding array<double>")
    assert found(nb.nearest(doubles, ASKED)) == expected

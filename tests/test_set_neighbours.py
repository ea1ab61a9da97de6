"""The k most similar sets against comparing all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from weftline.operators import set_neighbours as sn

SCHEMA = "member bigint, element bigint"


def brute(rows, k):
    sets = {}
    for m, e in rows:
        if m is not None and e is not None:
            sets.setdefault(m, set()).add(e)
    out = []
    for u, a in sets.items():
        near = []
        for v, b in sets.items():
            common = len(a & b)
            if u != v and common:
                near.append((-common / (len(a) + len(b) - common), v, common, len(a), len(b)))
        out += [(u, i, *x[1:]) for i, x in enumerate(sorted(near)[:k], 1)]
    return sorted(out)


def found(df):
    return sorted(map(tuple, df.select("member", "rank", "other", "common", "n", "m").collect()))


def some_rows(seed, members, elements, size):
    """Popular elements, families of nearly equal sets, and copies."""
    rng = random.Random(seed)
    rows, base = [], []
    for m in range(members):
        if base and rng.random() < 0.4:
            mine = set(rng.choice(base))
            if rng.random() < 0.6 and len(mine) > 1:
                mine.remove(rng.choice(sorted(mine)))
                mine.add(rng.randrange(elements))
        else:
            mine = {min(int(rng.expovariate(6 / elements)), elements - 1) for _ in range(rng.randint(1, size))}
            base.append(mine)
        rows += [(m * 3 + 1, e) for e in mine]
    return rows + rows[:20]


@pytest.mark.parametrize("seed, k", [(1, 3), (2, 8)])
def test_against_all_pairs(spark, seed, k):
    rows = some_rows(seed, 250, 150, 20)
    got = found(sn.similar_sets(spark.createDataFrame(rows, SCHEMA), k, first=2, list_rows=16, group_rows=200))
    assert got == brute(rows, k)


@pytest.mark.parametrize("seed, k, block_sets", [(6, 3, 40), (7, 6, 25), (8, 4, 1000)])
def test_few_elements_by_blocks(spark, monkeypatch, seed, k, block_sets):
    """Sets of very different sizes and copies, over elements that most of them share."""
    rng = random.Random(seed)
    rows = [(m, e) for m in range(180) for e in rng.sample(range(24), rng.choice([3, 9, 10, 22]))]
    rows += [(500 + m, e) for m in range(40) for e in (1, 2, 3, 5, 8)]
    monkeypatch.setattr(sn, "_by_lists", None)
    got = found(sn.similar_sets(spark.createDataFrame(rows, SCHEMA), k, block_sets=block_sets))
    assert got == brute(rows, k)


@pytest.mark.parametrize("copies", [1, 6])
def test_blocks_send_on_only_what_may_be_among_the_best(spark, monkeypatch, copies):
    """Nothing below the bound of the first round; nothing at all where own copies are the best."""
    rng = random.Random(9)
    sets = [rng.sample(range(24), 10) for _ in range(240)]
    rows = [(1_000 * c + m, e) for c in range(copies) for m, s in enumerate(sets) for e in s]
    sent, meet = [], sn._meet_blocks

    def counted(*args):
        met = meet(*args)
        sent.append(met.count())
        return met

    monkeypatch.setattr(sn, "_meet_blocks", counted)
    got = found(sn.similar_sets(spark.createDataFrame(rows, SCHEMA), 3, block_sets=60))
    assert got == brute(rows, 3)
    distinct = len({tuple(sorted(s)) for s in sets})
    # Three other blocks, of which each set was sent its best four.
    assert sent[1] < (3 * 4 * distinct if copies == 1 else 1)


def test_few_elements_by_lists(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(m, e) for m in range(120) for e in rng.sample(range(24), rng.choice([3, 9, 22]))]
    monkeypatch.setattr(sn, "_by_blocks", None)
    got = found(sn.similar_sets(spark.createDataFrame(rows, SCHEMA), 4, list_rows=30, few_elements=0))
    assert got == brute(rows, 4)


def test_large_sets_and_one_element_in_all(spark):
    rows = some_rows(3, 150, 100, 12) + [(m * 3 + 1, 500) for m in range(150)]
    rows += [(7000 + i, e) for i in range(4) for e in range(0, 90 - i)]
    got = found(sn.similar_sets(spark.createDataFrame(rows, SCHEMA), 4, large=30, list_rows=40))
    assert got == brute(rows, 4)


def test_defaults(spark):
    rows = some_rows(4, 120, 60, 9)
    assert found(sn.similar_sets(spark.createDataFrame(rows, SCHEMA), 5)) == brute(rows, 5)


def test_equal_sets_of_a_third_of_all(spark):
    rows = [(i, e) for i in range(300) for e in (1, 2, 3)] + some_rows(5, 100, 50, 6)
    rows = [(m, e) for m, e in rows if m is not None]
    got = found(sn.similar_sets(spark.createDataFrame(rows, SCHEMA), 5, list_rows=64))
    assert got == brute(rows, 5)


def test_edge_cases(spark):
    assert found(sn.similar_sets(spark.createDataFrame([], SCHEMA), 3)) == []
    rows = [(1, 5), (2, 6), (None, 5), (3, None), (4, 5), (4, 5)]
    extra = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", id int, rank int").select("member", "element")
    assert found(sn.similar_sets(extra, 3)) == [(1, 1, 4, 1, 1, 1), (4, 1, 1, 1, 1, 1)]


def test_long_lists_are_cut(spark, monkeypatch):
    """No task gets more than a few times a block of a list that a third of all sets share."""
    rows = [(i, e) for i in range(400) for e in (1, 1000 + i)]
    of_blocks = sn._best_in_lists

    def bounded(k):
        compare = of_blocks(k)

        def checked(probing, listed):
            if len(probing) > 130 or len(listed) > 130:
                raise ValueError(f"{len(probing)} and {len(listed)} sets in one task")
            return compare(probing, listed)

        return checked

    monkeypatch.setattr(sn, "_best_in_lists", bounded)
    got = found(sn.similar_sets(spark.createDataFrame(rows, SCHEMA), 3, list_rows=50, group_rows=50))
    assert got == brute(rows, 3)


def test_a_block_is_unpacked_once(monkeypatch):
    """Not again for each strip that meets it; shared elements are counted where pairs are near."""
    rng = np.random.default_rng(2)
    cells = rng.random((600, 40)) < 0.3
    bits = [np.packbits(row).tobytes() for row in cells]
    table = {"id": np.arange(600), "bits": pa.array(bits, pa.binary()), "n": cells.sum(axis=1).astype("i4")}
    asking = pa.table(table | {"least": np.full(600, 0.1)})
    unpacked, real = [], sn._BitSets.as_matrix
    monkeypatch.setattr(sn, "_STRIP", 50)
    monkeypatch.setattr(
        sn._BitSets, "as_matrix", lambda self, *at: (unpacked.append(len(m := real(self, *at))), m)[1]
    )
    found = sn._best_in_blocks(3)(asking, pa.table(table)).to_pylist()
    assert sum(unpacked) <= 2 * 600
    common = cells.astype(int) @ cells.T
    assert len(found) == 1_800 and all(r["common"] == common[r["id"], r["other"]] for r in found)

"""Near duplicates against a comparison of every pair."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weftline.llm import near_dup
from weftline.llm.graph import components
from weftline.llm.word_hashes import NOT_BLANK, blocks
from weftline.llm.word_hashes import words as hashed
from weftline.shared import Tables

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
FOLDER = "/root/testdata/sf0.001"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute(rows):
    """(doc_id, size, component, kept) of every row, by all pairs of distinct sets."""
    sets = [shingles(t) for _, t in rows]
    distinct = list(dict.fromkeys(s for s in sets if s))
    parent = list(range(len(distinct)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(distinct):
        for j in range(i):
            b = distinct[j]
            if 100 * len(a & b) >= 75 * len(a | b):
                parent[find(i)] = find(j)
    group = {s: find(i) for i, s in enumerate(distinct)}
    least = {}
    for (doc, _), s in zip(rows, sets):
        if s and doc is not None:
            least[group[s]] = min(doc, least.get(group[s], doc))
    out = []
    for (doc, _), s in zip(rows, sets):
        component = least.get(group[s]) if s else doc
        out.append((doc, len(s), component, True if None in (doc, component) else doc == component))
    return sorted(out, key=repr), group


def changed(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.random()}"
    return " ".join(w)


def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    common = " ".join(rng.choices(vocabulary, k=30))
    rows = []
    for _ in range(40):
        base = " ".join(rng.choices(vocabulary, k=rng.choice([6, 20, 60, 200])))
        if rng.random() < 0.5:
            base = f"{base} {common}"
        rows.append(base)
        rows += [changed(rng, base, rng.randrange(1, 4)) for _ in range(rng.randrange(4))]
    seed = " ".join(rng.choices(vocabulary, k=150))
    rows += [seed] * 200 + [changed(rng, seed, 1) for _ in range(200)]
    chain = rng.choices(vocabulary, k=100)
    for _ in range(12):
        rows.append(" ".join(chain))
        chain = chain[6:] + rng.choices(vocabulary, k=6)
    rows += ["a b c", "A  b\tc", "a b", "", " \n", None, "a b c d e", "a b c d"]
    rows += ["hot line of seven words for all", "x " * 5000]
    rng.shuffle(rows)
    listed = [(i, t) for i, t in enumerate(rows)]
    return [*listed, listed[5], listed[5], (None, listed[9][1]), (None, "unnamed text of six words"), (7, "another text under seven now here")]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return df.withColumn("node", F.lit("x")).withColumn("mark", F.lit(1.5)).repartition(4)


def test_all_pairs(spark):
    rows = corpus()
    got = near_dup.near_duplicates(frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)[0]


def test_one_of_each(spark):
    rows = corpus()
    df = frame(spark, rows)
    kept = near_dup.one_of_each(df)
    assert kept.columns == df.columns
    left = [(r["doc_id"], r["text"]) for r in kept.collect()]
    group = brute(rows)[1]
    wordless = sorted((r for r in rows if not shingles(r[1])), key=repr)
    assert sorted((r for r in left if not shingles(r[1])), key=repr) == wordless
    named = [group[shingles(t)] for _, t in left if shingles(t)]
    assert sorted(named) == sorted(set(group.values()))


def test_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = near_dup.near_duplicates(docs).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)[0]


def passages():
    """Texts that share long passages to all degrees, some of them linked only through these."""
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    common = [" ".join(rng.choices(vocabulary, k=80)) for _ in range(2)]
    rows = []
    for k in range(150):
        own = " ".join(f"o{rng.random()}" for _ in range(rng.randrange(0, 40)))
        rows.append(rng.choice([f"{common[0]} {own}", f"{own} {common[0]}", f"{common[0]} {common[1]} {own}", f"{common[1]} {own}"]))
        if k % 10 == 0:
            rows.append(changed(rng, rows[-1], 2))
    return list(enumerate(rows))


@pytest.mark.parametrize("few", [1, 4, 16])
def test_large_buckets_by_shingles(spark, monkeypatch, few):
    monkeypatch.setattr(near_dup, "FEW", few)
    rows = passages()
    got = near_dup.near_duplicates(frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)[0]


def test_empty_table(spark):
    df = frame(spark, corpus()).limit(0)
    assert near_dup.near_duplicates(df).count() == 0
    assert near_dup.one_of_each(df).count() == 0


def test_estimate_is_near_the_similarity():
    rng = random.Random(9)
    for size in (4, 20, 100, 3000):
        for share in (0.3, 0.6, 0.75, 0.9):
            errors = []
            for _ in range(20):
                both = int(size * share)
                texts = []
                common = [f"c{rng.random()} " * 5 for _ in range(both)]
                for side in "ab":
                    own = [f"{side}{rng.random()} " * 5 for _ in range(size - both)]
                    texts.append([hash_of(x) for x in common + own])
                sets = [near_dup.Sets(np.sort(np.array(x, "u8")), np.array([0, len(x)])) for x in texts]
                one, other = (near_dup.sketches(s) for s in sets)
                n = np.array([size])
                guess = near_dup.estimate(one, other, n, n)[0]
                errors.append(guess - both / (2 * size - both))
            assert abs(np.mean(errors)) < 0.06 and np.max(np.abs(errors)) < 0.25


def hash_of(text):
    (block,) = blocks(pa.array([text]))
    return int(near_dup.shingle_sets(hashed(block, NOT_BLANK)).shingles[0])


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(300)]
    edges += [(2000 + rng.randrange(100), 2000 + rng.randrange(100)) for _ in range(60)]
    edges = [(rng.sample(e, 2)) for e in edges]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), Tables(spark)).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    assert got == {x: find(x) for e in edges for x in e if len(set(e)) > 1 or x in got}


def test_small_sets_need_no_estimate():
    rng, n = np.random.default_rng(0), 2000
    larger = rng.integers(0, 2**63, size=(n, 4), dtype="u8")
    smaller = np.sort(larger[:, :3], axis=1)
    sets = [near_dup.Sets(x.reshape(-1), np.arange(n + 1) * x.shape[1]) for x in (np.sort(larger, axis=1), smaller)]
    a, b = (near_dup.sketches(s) for s in sets)
    sizes = [np.full(n, 4), np.full(n, 3)]
    low = near_dup.estimate(a, b, *sizes) < near_dup.SIMILAR / 100 - near_dup.MARGIN
    assert (low & (near_dup.band_keys(a) == near_dup.band_keys(b)).any(axis=1)).any()
    columns = {"a": np.arange(n), "b": np.arange(n) + n, "n_a": sizes[0], "n_b": sizes[1]}
    columns |= {f"sketch_{k}": [x.tobytes() for x in codes] for k, codes in (("a", a), ("b", b))}
    (kept,) = near_dup._promising(iter([pa.RecordBatch.from_pydict(columns)]))
    assert kept.column("a").to_pylist() == list(range(n))


def test_few_files_do_not_take_tasks_from_the_work(spark):
    def parts(batches):
        from pyspark import TaskContext

        for batch in batches:
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()] * len(batch)})

    tables = Tables(spark)
    made = spark.range(1000, numPartitions=8).mapInArrow(parts, "part bigint")
    written = tables.cut(made, "narrow", 1000)
    assert len(written.inputFiles()) == 1
    assert written.distinct().count() == 8

"""Shards of near equal bytes, gapless slots, and copies side by side."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from weftline.llm import sharding


def check(got, shards, slack):
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in got:
        text = r["document"]["text"]
        assert r["size"] == (len(text.encode()) if text else 0) + 8
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    total = sum(sizes.values())
    largest = max((r["size"] for r in got), default=0)
    for k in range(shards):
        assert abs(sizes[k] - total / shards) <= slack * total / shards + 2 * largest


def shard(spark, rows, shards=24):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("shard", F.lit("x"))
    got = sharding.shard_documents(df.repartition(3), shards).collect()
    assert len(got) == len(rows)
    key = lambda x: repr(tuple(x))
    assert sorted(((r["document"]["doc_id"], r["document"]["text"]) for r in got), key=key) == sorted(rows, key=key)
    return got


def test_mixed_texts(spark):
    rng = random.Random(1)
    rows = [(i, "é" * rng.choice([0, 3, 50, 400])) for i in range(3000)]
    rows += [(None, None), (5, None), (5, None), (9, "z" * 5000)]
    check(shard(spark, rows), 24, 0.01)


def test_a_third_of_the_rows_are_copies(spark):
    rows = [(i, f"text {i}") for i in range(2000)] + [(i, "the same text") for i in range(2000, 3000)]
    got = shard(spark, rows)
    check(got, 24, 0.01)
    holders = sorted({r["shard"] for r in got if r["document"]["text"] == "the same text"})
    assert holders == list(range(holders[0], holders[-1] + 1))


def test_rows_equal_in_every_column(spark):
    rows = [(i, f"text {i}") for i in range(400)] + [(1, "the same row")] * 400
    check(shard(spark, rows, 8), 8, 0.01)


def test_few_rows_and_none(spark):
    rows = [(1, "a"), (2, "b")]
    check(shard(spark, rows, 4), 4, 1)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").limit(0)
    assert sharding.shard_documents(df, 4).count() == 0


def test_boundaries_against_a_sort(spark):
    rng = random.Random(2)
    rows = [(rng.choice([-5, 7, rng.getrandbits(63)]), rng.getrandbits(63) - (1 << 62), rng.randint(1, 50)) for _ in range(2000)]
    keys = spark.createDataFrame(rows, "high bigint, low bigint, size bigint")
    boundaries, stuck = sharding.find_boundaries(keys, 10, 0.0005)
    assert not stuck
    total = sum(r[2] for r in rows)
    for j, b in enumerate(boundaries, 1):
        below = sum(s for h, low, s in rows if b.high is None or (h, low) < (b.high, b.low))
        assert abs(below - total * j / 10) <= 50

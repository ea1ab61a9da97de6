"""Toxicity by held-out accuracy, and the counterfactual penalty by its effect."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import toxicity

FOLDER = "/root/testdata/sf0.1"


def corpus(n, rng, biased):
    rows, labels = [], []
    for i in range(n):
        w = [f"w{rng.randrange(300)}" for _ in range(60)]
        bad = rng.random() < 0.25
        if bad:
            w[rng.randrange(60)] = rng.choice(["vilest", "awful", "nastier"])
        if rng.random() < (0.8 if bad else 0.1) * biased:
            w[rng.randrange(60)] = "muslims"
        if rng.random() < 0.1:
            w[rng.randrange(60)] = "christians"
        rows.append((i, " ".join(w) + ". " + " ".join(w[:5])))
        labels.append((i, int(bad)))
    return rows, labels


def test_held_out(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = toxicity.train(docs, labels)
    held = toxicity.labels_of(labels, "toxic").where("held_out")
    rows = docs.join(held, F.col("doc_id") == F.col("_doc"))
    rows = rows.withColumn("p", toxicity.predicted(toxicity.score(model, spark)(F.col("text"))))
    counts = {(r["label"], r["p"]): r["count"] for r in rows.groupBy("label", "p").count().collect()}
    assert counts.get((1, 1), 0) / (counts.get((1, 1), 0) + counts.get((1, 0), 0)) > 0.85
    assert counts.get((0, 1), 0) / (counts.get((0, 1), 0) + counts.get((0, 0), 0)) < 0.02


def test_naming_a_group_does_not_move_the_score(spark, monkeypatch):
    rng = random.Random(3)
    rows, labels = corpus(1500, rng, 1.0)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    asked = [(0, "we met the muslims of the town"), (1, "we met the christians of the town"), (2, "awful w1 w2")]
    asked = spark.createDataFrame(asked, "doc_id bigint, text string")

    def scores():
        model = toxicity.train(docs, marks)
        scored = asked.withColumn("s", toxicity.score(model, spark)(F.col("text")))
        return [r["s"] for r in scored.orderBy("doc_id").collect()]

    fair = scores()
    monkeypatch.setattr(toxicity, "SWAP_PENALTY", 0.0)
    plain = scores()
    assert abs(fair[0] - fair[1]) < 0.5 * abs(plain[0] - plain[1])
    assert fair[2] > 0.3


def test_edge_cases(spark):
    rng = random.Random(4)
    rows, labels = corpus(400, rng, 0.0)
    rows += [(None, "awful"), (500, None), (501, ""), (502, "awful " + "w1 " * 50_000), (0, rows[0][1])]
    labels += [(None, 1), (3, None), (4, 1 - labels[4][1]), (5, labels[5][1]), (9999, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("label", F.lit("x"))
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.train(docs.select("doc_id", "text"), marks)
    scored = docs.withColumn("s", toxicity.score(model, spark)(F.col("text"))).collect()
    assert all(0 <= r["s"] <= 1 for r in scored)
    by_id = {r["doc_id"]: r["s"] for r in scored}
    assert by_id[500] == by_id[501] < 0.3 < by_id[502]
    assert docs.limit(0).withColumn("s", toxicity.score(model, spark)(F.col("text"))).count() == 0


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "a b"), (3, "c")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    one = spark.createDataFrame([(1, 0), (3, 0)], "doc_id bigint, toxic int")
    for marks, expected in ((none, 0.0), (one, 0.3)):
        model = toxicity.train(docs, marks)
        got = docs.withColumn("s", toxicity.score(model, spark)(F.col("text"))).collect()
        assert all(r["s"] <= expected for r in got)
    assert [r["s"] for r in docs.withColumn("s", toxicity.score(toxicity.train(docs, none), spark)(F.col("text"))).collect()] == [0.0, 0.0]


@pytest.mark.parametrize("share, penalty", [(0.3, 0.0), (0.3, 1.0), (0.12, 1.0), (0.12, 10.0)])
def test_fit_against_plain_descent(monkeypatch, share, penalty):
    """With few features a row, and with swaps, at any strength of the penalty."""
    monkeypatch.setattr(toxicity, "SWAP_PENALTY", penalty)
    rng = np.random.Generator(np.random.PCG64(1))
    dense = rng.random((300, 8)) < share
    labels = (dense[:, 0] | dense[:, 3] | (rng.random(300) < 0.05)).astype(float)
    rows, places = np.nonzero(dense)
    changes = np.zeros((2, 8))
    changes[0, [3, 4]], changes[1, [5, 6]] = (1, -1), (1, -1)
    weight = np.array([0.75, 0.25])
    w, b = toxicity.fit(rows, places, labels, 8, changes, weight)
    per_row = dense.sum() / 300 + 1
    v, c = np.zeros(8), 0.0
    for _ in range(40_000):
        error = 1 / (1 + np.exp(-(dense @ v + c))) - labels
        slope = dense.T @ error / 300 + toxicity.RIDGE * v
        slope += 2 * penalty * changes.T @ (weight * (changes @ v)) / per_row
        v -= 0.05 * slope
        c -= 0.05 * error.mean()
    margin = lambda w, b: 1 / (1 + np.exp(-(dense @ w + b)))
    assert np.abs(margin(w, b) - margin(v, c)).max() < 0.05
    if penalty >= 1:
        assert abs(w[3] - w[4]) < 0.5 * abs(w[0])


def test_features_and_scores_against_plain_words(spark):
    """Places chosen and scores, from sets of words and heads."""
    rng = random.Random(6)
    rows, labels = corpus(300, rng, 0.5)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")

    def keys(text):
        words = re.findall(r"[^\x20\x09-\x0D.,;:!?()\[\]{}\"'#*$%&|<>]+", text.lower())
        return {(0, w) for w in words} | {(h, w[:h]) for w in words for h in toxicity.HEADS if len(w) > h}

    def place(key):
        (block,) = toxicity.blocks(toxicity.pa.array([key[1]]))
        sums = toxicity.byte_sums(block.data)
        span = toxicity.hash_spans(sums, np.array([0]), np.array([len(key[1])]))
        return int(toxicity.mix(span + np.uint64(key[0]))[0] >> np.uint64(64 - toxicity.PLACE_BITS))

    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    trained = [(keys(t), y) for (i, t), (_, y) in zip(rows, labels, strict=True) if i not in held]
    n = {y: sum(z == y for _, z in trained) for y in (0, 1)}
    seen = {y: Counter(p for ks, z in trained if z == y for p in {place(k) for k in ks}) for y in (0, 1)}
    total, expected = sum(n.values()), set()
    for p in set(seen[0]) | set(seen[1]):
        a, b = seen[1][p], seen[0][p]
        c, d = n[1] - a, n[0] - b
        if a + b >= toxicity.MIN_ROWS and c + d > 0:
            if total * (a * d - b * c) ** 2 / ((a + b) * (c + d) * n[0] * n[1]) >= toxicity.MIN_CHI_SQUARE:
                expected.add(p)
    sample = docs.join(marks.withColumnRenamed("toxic", "label"), "doc_id")
    sample = sample.where(~sample.doc_id.isin(sorted(held))).select("text", "label")
    assert set(toxicity.choose_places(sample, n[0], n[1]).tolist()) == expected

    model = toxicity.train(docs, marks)
    scored = docs.withColumn("s", toxicity.score(model, spark)(F.col("text"))).collect()
    for r in scored:
        margin = model.bias + sum(float(model.weights[p]) for p in {place(k) for k in keys(r["text"])})
        assert abs(r["s"] - 1 / (1 + np.exp(-margin))) < 1e-9

"""Co-trained quality by held-out accuracy; counts and calibration against plain Python."""

import math
import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from weftline.llm import cotraining

FOLDER = "/root/testdata/sf0.01"


def corpus(n, seed):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.6
        pool = "abcdefgh" if good else "efghijkl"
        text = " ".join(rng.choice(pool) * rng.randint(1, 6) for _ in range(30))
        rows.append((i, text, "en", rng.choice(["s1", "s2"] if good else ["s2", "s3"])))
        if rng.random() < 0.3:
            labels.append((i, int(good)))
    return rows, labels, [int("a" in r[1] or "b" in r[1]) for r in rows]


SCHEMA = "doc_id bigint, text string, lang string, source string"


def test_views_learn_from_each_other(spark):
    rows, labels, truth = corpus(1500, 1)
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    got = cotraining.co_train(docs, marks).collect()
    right = sum((r["score"] >= 0.5) == truth[r["doc_id"]] for r in got)
    assert right / len(got) > 0.95
    assert all(0 <= r[c] <= 1 for r in got for c in ("score", "text_score", "meta_score"))


def test_held_out_beats_chance(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    got = cotraining.co_train(docs, labels).join(labels, "doc_id").where("held_out")
    rows = [(r["score"], r["quality"]) for r in got.collect()]
    wins = [(g > b) + 0.5 * (g == b) for g, y in rows if y for b, z in rows if not z]
    assert np.mean(wins) > 0.6


def test_edge_cases(spark):
    rows, labels, _ = corpus(200, 2)
    rows += [(None, "a b", None, None), (300, None, "en", None), (301, "", None, "s1"), rows[0], (302, "a " * 50_000, "en", "s9")]
    labels += [(None, 1), (3, None), (4, 1), (4, 0), (9999, 1)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit(1)).withColumn("odds", F.lit(2))
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    got = cotraining.co_train(docs, marks).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert cotraining.co_train(docs.limit(0), marks).count() == 0
    unlabelled = cotraining.co_train(docs, marks.limit(0)).collect()
    assert {round(r["score"], 6) for r in unlabelled} == {0.5}


def test_platt_recovers_a_line():
    odds = np.linspace(-5, 5, 101)
    p = 1 / (1 + np.exp(-(0.5 * odds + 1)))
    a, b = cotraining.platt(odds, p * 1000, np.full(101, 1000.0))
    assert abs(a - 0.5) < 1e-3 and abs(b - 1) < 1e-3


def word_place(word):
    (block,) = cotraining.blocks(cotraining.pa.array([word]))
    return int(cotraining.words(block, cotraining.NOT_BLANK).hashes[0] >> np.uint64(64 - cotraining.TEXT_BITS))


def plain_run(rows, metas, labels):
    """Scores by counting over sets, one document at a time."""
    features = [({word_place(w) for w in r[1].split(" ") if w}, list(m)) for r, m in zip(rows, metas, strict=True)]
    label = {i: y for i, y in labels}
    known = [label.get(r[0]) for r in rows]
    held = [r[0] in label and zlib.crc32(str(r[0]).encode()) % 4 == 2 for r in rows]
    sure = math.log(cotraining.CONFIDENT / (1 - cotraining.CONFIDENT))

    def odds(view, i, learned):
        weights, prior = learned[view]
        found = features[i][view]
        total = sum(weights.get(p, 0.0) for p in found)
        total = total / math.sqrt(max(1, len(found))) if view == 0 else total
        return min(max(total + prior, -cotraining.LIMIT), cotraining.LIMIT)

    learned = None
    for _ in range(cotraining.ROUNDS + 1):
        made = []
        for view in (0, 1):
            n, counts = [0, 0], [Counter(), Counter()]
            for i in range(len(rows)):
                target = known[i]
                if target is None and learned is not None:
                    other = odds(1 - view, i, learned)
                    target = 1 if other >= sure else 0 if other <= -sure else None
                if target is not None and not held[i]:
                    n[target] += 1
                    counts[target].update(features[i][view])
            s = cotraining.SMOOTHING
            weights = {
                p: math.log((counts[1][p] + s) / (n[1] + 2 * s)) - math.log((counts[0][p] + s) / (n[0] + 2 * s))
                for p in counts[0] | counts[1]
            }
            made.append((weights, math.log((n[1] + s) / (n[0] + s))))
        learned = made
    judged = [(odds(0, i, learned), odds(1, i, learned)) for i in range(len(rows))]
    tested = [i for i in range(len(rows)) if held[i]]
    lines = []
    for view in (0, 1):
        bins = {}
        for i in tested:
            of = bins.setdefault(math.floor(judged[i][view] / cotraining.BIN + 0.5), [0, 0])
            of[0] += known[i]
            of[1] += 1
        at = np.array(sorted(bins), float)
        lines.append(cotraining.platt(at * cotraining.BIN, *(np.array([bins[b][j] for b in at]) for j in (0, 1))))
    good = sum(known[i] for i in tested)
    prior = math.log((good + 0.5) / (len(tested) - good + 0.5))
    calibrated = [[a * j + b for (a, b), j in zip(lines, both, strict=True)] for both in judged]
    return [[1 / (1 + math.exp(-x)) for x in (t, m, t + m - prior)] for t, m in calibrated]


def test_whole_run_against_plain_counts(spark):
    rows, labels, _ = corpus(300, 5)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    metas = {r["doc_id"]: r["m"] for r in docs.select("doc_id", cotraining._metadata().alias("m")).collect()}
    got = cotraining.co_train(docs, spark.createDataFrame(labels, "doc_id bigint, quality int")).collect()
    expected = plain_run(rows, [metas[r[0]] for r in rows], labels)
    by_id = {r["doc_id"]: [r["text_score"], r["meta_score"], r["score"]] for r in got}
    for r, e in zip(rows, expected, strict=True):
        assert np.allclose(by_id[r[0]], e, atol=1e-6), r[0]

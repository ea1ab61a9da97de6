"""Measures against plain Python, bounds against the exact binomial distribution."""

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from weftline.llm import quality_rules


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    repeated = {i + j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(w),
        sum(map(len, w)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def texts():
    rng = random.Random(0)
    out = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "a a a a a", "É É É É", "x\x0by z\x0cq", "a\n\na\n a\n"]
    for _ in range(200):
        out.append("".join(rng.choices(["a", "b ", "c\n", "É", " ", "#", "$ ", "ab ", "<|>", "\t", "🤦🏼‍♂️", "d e f "], k=rng.randrange(60))))
    return [*out, "word " * 20_000, out[20], out[20]]


def test_measures(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("measures_", F.lit(1))
    got = quality_rules.measured(df).collect()
    for r in got:
        assert tuple(r["measures"][m] for m in quality_rules.MEASURES) == plain(r["text"]), r["text"]


def exact_tail(k, n, p):
    return math.fsum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))


def test_binomial_tail(spark):
    cases = [(k, n) for n in (1, 5, 40, 300, 1000) for k in (0, 1, 2, 5, 20) if k <= n]
    df = spark.createDataFrame(cases, "k bigint, n bigint")
    tail = quality_rules.binomial_tail(F.col("k"), F.col("n"), quality_rules.ALPHA)
    for r in df.withColumn("p", tail).collect():
        if r["k"] >= r["n"] * quality_rules.ALPHA:
            assert r["p"] == 1 and exact_tail(r["k"], r["n"], quality_rules.ALPHA) > 0.4
        else:
            assert math.isclose(r["p"], exact_tail(r["k"], r["n"], quality_rules.ALPHA), rel_tol=1e-9)
    large = spark.createDataFrame([(24_000, 1_000_000)], "k bigint, n bigint").withColumn("p", tail).first()["p"]
    assert 0 < large < 1e-9


def test_cutoffs_hold_their_risk(spark):
    rng = random.Random(1)
    rows = []
    for stratum, n in (("en", 2000), ("fr", 1500), (None, 400), ("xx", 30)):
        for _ in range(n):
            good = rng.random() < 0.8
            symbols = rng.random() * 0.1 if good else rng.random()
            rows.append((stratum, good, symbols, rng.random(), 0.0, 0.0))
    df = spark.createDataFrame(rows, "stratum string, good boolean, symbols double, upper double, lines double, repeats double")
    found = {r["stratum"]: r for r in quality_rules.certify(df).collect()}
    assert found["en"]["symbols"] is not None and found["fr"]["symbols"] is not None
    assert "xx" not in found
    for stratum, r in found.items():
        assert r["upper"] is None and r["lines"] is None and r["repeats"] is None
        good = [x for x in rows if x[0] == stratum and x[1]]
        lost = sum(x[2] > r["symbols"] for x in good)
        assert exact_tail(lost, len(good), quality_rules.ALPHA) <= quality_rules.DELTA / 16


def test_judge_and_keep(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(900):
        good = rng.random() < 0.7
        w = [f"w{rng.random()}" for _ in range(60)]
        rows.append((i, " ".join(w if good else [x + "###" for x in w]), "en"))
        labels.append((i, int(good)))
    rows += [(None, rows[0][1], None), (5, rows[5][1], "en"), (950, None, "en"), (951, "few words", None)]
    labels += [(3, 1 - labels[3][1]), (None, 1), (8, None), (4, labels[4][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("kept", F.lit("x"))
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    got = quality_rules.judge(docs, marks).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r["kept"] for r in got}
    assert not by_id[950] and not by_id[951] and by_id[None]
    assert all(by_id[i] == ("###" not in t) for i, t, _ in rows if i is not None and i < 900)
    kept = quality_rules.keep_good(docs, marks)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id IS NOT NULL").collect()) == sorted(
        r["doc_id"] for r in got if r["kept"] and r["doc_id"] is not None
    )
    assert quality_rules.judge(docs.limit(0), marks).count() == 0
    assert quality_rules.judge(docs, marks.limit(0)).where("NOT base_failed AND NOT kept").count() == 0


def test_certified_together(spark):
    def document(k, mark):
        w = [f"w{k}x{j}" for j in range(60)]
        return " ".join([w[0] + mark * 200, *w[1:]])

    # Two rules that each reject 1.5 % of the good documents, and others.
    rows, labels = [], []
    for i in range(4000):
        good = i < 2000
        mark = "" if good and i % 200 >= 6 else "#" if i % 2 else "A"
        rows.append((i, document(i, mark), "en"))
        labels.append((i, int(good)))
    # The good texts of another stratum: 470 others, 30 that the rule rejects, 2,000 copies of one.
    for i in range(4000, 8000):
        good = i < 6500
        k, mark = (4000, "") if i < 6000 else (i, "#" if i < 6030 or not good else "")
        rows.append((i, document(k, mark), "fr"))
        labels.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    good = {i for i, mark in labels if mark}

    def lost(**how):
        kept = {r["doc_id"] for r in quality_rules.keep_good(docs, marks, **how).select("doc_id").collect()}
        return [
            len({t for i, t, s in rows if s == stratum and i in good - kept})
            / len({t for i, t, s in rows if s == stratum and i in good})
            for stratum in ("en", "fr")
        ]

    each, together = lost(), lost(together=True)
    assert min(each) > quality_rules.ALPHA
    assert together == [0, 0]

"""Licence matches against sets of bigrams in plain Python."""

import random
import re

from pyspark.sql import functions as F

from weftline.llm import licenses

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bigrams(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))
    return set(zip(w, w[1:]))


def brute(text, listed):
    text = text or ""
    units = [*enumerate(text.split("\n")), (licenses.WHOLE, text)]
    best = None
    for line, unit in units:
        for k, (name, template) in enumerate(sorted(listed)):
            a, b = bigrams(unit), bigrams(template)
            if not a or not b:
                continue
            dice = 2 * len(a & b) / (len(a) + len(b))
            if dice >= licenses.THRESHOLD:
                rank = (-dice, line == licenses.WHOLE, line, k)
                if best is None or rank < best[0]:
                    best = (rank, (name, dice, line))
    return best[1] if best else None


def texts():
    rng = random.Random(1)
    out = [None, "", "\n\n", "MIT", "word", "Released under the MIT license", "no licence here at all\nnothing"]
    for _ in range(150):
        name, text = rng.choice(licenses.TEMPLATES)
        w = text.split()
        for _ in range(rng.randrange(1 + len(w) // 5)):
            w[rng.randrange(len(w))] = rng.choice(["x", "THE", "§"])
        parts = [" ".join(w[: rng.choice([len(w), len(w) - 2])])]
        if rng.random() < 0.6:
            parts.insert(rng.randrange(2), " ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(40))))
        if rng.random() < 0.3:
            parts.append(rng.choice(licenses.TEMPLATES)[1])
        out.append(rng.choice(["\n", " ", "\r\n\n"]).join(parts))
    return [*out, out[9], "plain " * 50_000 + "\n" + licenses.TEMPLATES[0][1]]


def test_against_sets(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("license", F.lit(2))
    got = docs.select("doc_id", licenses.scan(spark)(F.col("text")).alias("r")).collect()
    for r in got:
        expected = brute(rows[r["doc_id"]][1], licenses.TEMPLATES)
        found = None if r["r"] is None or r["r"]["license"] is None else tuple(r["r"])
        assert found == expected, rows[r["doc_id"]][1]
    assert docs.limit(0).select(licenses.scan(spark)(F.col("text"))).count() == 0


def wrapped(text, columns=76):
    lines, line = [], ""
    for w in text.split():
        if line and len(line) + 1 + len(w) > columns:
            lines.append(line)
            line = ""
        line = f"{line} {w}".strip()
    return [*lines, line]


def found_passages(spark, texts, *listed):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = docs.select("doc_id", licenses.passages(spark, *listed)(F.col("text")).alias("r")).collect()
    return [r["r"] for r in sorted(got, key=lambda r: r["doc_id"])]


def brute_runs(text, listed):
    """Per licence the best run's coefficient; and the first of all licences."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    best = {}
    for k, (name, template) in enumerate(sorted(listed)):
        b = bigrams(template)
        for i in range(len(w) - 1):
            run, common = set(), 0
            for j in range(i + 1, len(w)):
                if (g := (w[j - 1], w[j])) not in run:
                    run.add(g)
                    common += g in b
                dice = 2 * common / (len(run) + len(b))
                if dice >= licenses.THRESHOLD:
                    best[name] = min(best.get(name, (0,)), (-dice, -len(b), j, k))
    return {name: -x[0] for name, x in best.items()}, min(best, key=best.get, default=None)


def test_passages_against_every_run(spark):
    rng = random.Random(4)
    cases = [t for t in texts() if t is None or len(t.split()) < 130][:90]
    for name, text in licenses.TEMPLATES * 2:
        w = text.split()[:50]
        for _ in range(rng.randrange(1 + len(w) // 4)):
            w.insert(rng.randrange(len(w)), rng.choice(["x", "the license", "under the", *w]))
        cases.append(" ".join(["under the", *w, "permission is", *w[: rng.randrange(len(w))], "end"]))
    got = found_passages(spark, cases, licenses.TEMPLATES)
    assert any(r and r["others"] for r in got)
    for text, r in zip(cases, got, strict=True):
        best, first = brute_runs(text, licenses.TEMPLATES)
        found = [] if r is None else [r, *r["others"]]
        assert {x["license"]: x["dice"] for x in found} == best, text
        assert (r and r["license"]) == first, text


def test_notices_wrapped_or_inside_a_line(spark):
    rng = random.Random(5)

    def filler():
        return [" ".join(f"w{rng.randrange(3000)}" for _ in range(9)) for _ in range(30)]

    cases = []
    for sign in ("", "# ", " * "):
        for name, text in licenses.TEMPLATES:
            lines = [sign + x for x in wrapped(text)]
            cases.append((name, "\n".join([*filler(), *lines, *filler()]), 30, 29 + len(lines)))
    inline = "Copyright 2021 Jane Doe and contributors. Released under the MIT License. All rights reserved worldwide."
    cases += [("MIT", inline, 0, 0), (None, "\n".join(filler() * 20), None, None)]
    cases.append(("MIT", "\n".join([f"{licenses.TEMPLATES[11][1]}\n"] * 300), 0, 0))
    for (name, text, line, last), r in zip(cases, found_passages(spark, [c[1] for c in cases]), strict=True):
        if name is None:
            assert r is None
        else:
            assert (r["license"], r["dice"], r["line"], r["last_line"]) == (name, 1.0, line, last), text
    lost = [brute(text, licenses.TEMPLATES) for _, text, _, _ in cases[:15]]
    assert lost.count(None) > 5


def test_whole_texts(spark):
    rng = random.Random(6)
    listed = (*licenses.NOTICES, *licenses.whole_texts())
    names = {name for name, _ in listed}
    assert {"AGPL-3.0", "Apache-2.0", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0"} <= names
    changed = []
    for name, text in listed:
        w = text.split()
        for _ in range(len(w) // 40):
            w[rng.randrange(len(w))] = "changed"
        changed.append((name, " ".join(w)))
    for share, cases in ((1.0, listed), (0.9, changed)):
        docs = ["\n".join(["Some words before.", *wrapped(text, 80), "And some after."]) for _, text in cases]
        for (name, _), r in zip(cases, found_passages(spark, docs), strict=True):
            assert r["license"] == name and r["dice"] >= share, (name, r)
    lost = [brute(text, licenses.TEMPLATES) for _, text in licenses.whole_texts()]
    assert lost.count(None) > 10

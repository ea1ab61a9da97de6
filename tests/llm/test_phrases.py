"""Phrase mining against counting everything."""

import random
import re
from collections import Counter

import pytest

from weftline.llm import phrases as p

SCHEMA = "doc_id bigint, text string, lang string"
WORD, END = re.compile(r"[^\x20\x09]+"), re.compile(r"[.,;:!?\x0A-\x0D]")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, support=10, longest=3, top=2000):
    counts, words = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        of = counts.setdefault(lang, Counter())
        for piece in END.split(lower(text or "")):
            w = WORD.findall(piece)
            words[lang] += len(w)
            for k in range(1, longest + 1):
                of.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {g: n for g, n in f.items() if len(g) > 1 and n >= support}
        inside = Counter()
        for g, n in found.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    inside[g[i : i + k]] = max(inside[g[i : i + k]], n)
        scored = []
        for g, a in found.items():
            if 100 * inside[g] >= 50 * a:
                continue
            score, _, l, r = min(
                (1_000_000 * a * a // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g))
            )
            scored.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, words[lang], -score))
    return sorted(out)


def some_rows(seed, n):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "é", "İx", "a b", "x\x1cy", "New", "York", "city"] + [f"w{i}" for i in range(30)]
    gaps = [" "] * 12 + ["  ", "\t", ". ", ", ", "\n", "\x0b", "?!", ": "]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(vocabulary) + rng.choice(gaps) for _ in range(rng.randint(0, 60)))
        if rng.random() < 0.3:
            text += "new York CITY hall" * rng.randint(1, 2)
        rows.append((i if rng.random() < 0.9 else None, text, rng.choice(["en", "en", "fr", None])))
    return rows


def found(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


@pytest.mark.parametrize("shards", [1, 3, 9])
def test_against_counting_everything(spark, shards):
    rows = some_rows(shards, 300)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(p.best_collocations(docs, shards=shards)) == brute(rows)


def test_longer_phrases_and_few_places(spark):
    rows = some_rows(4, 120)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = found(p.best_collocations(docs, top=7, support=6, longest=4))
    assert got == brute(rows, support=6, longest=4, top=7)


def test_small_buffers(spark, monkeypatch):
    monkeypatch.setattr(p, "GATHERED", 50)
    rows = some_rows(5, 40)
    scan = p._mine(2, None)
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"text": [r[1] for r in rows], "shard": pa.array([0] * 40, pa.int32()), "salt": [7] * 40})
    some = Counter()
    for out in scan(iter([batch])):
        for key, n in zip(out.column("key").to_pylist(), out.column("n").to_pylist(), strict=True):
            some[key] += n
    pairs = Counter()
    for _, text, _ in rows:
        for piece in END.split(lower(text)):
            w = WORD.findall(piece)
            pairs.update(zip(w, w[1:]))
    assert sorted(some.values()) == sorted(pairs.values())


def test_edge_cases(spark):
    assert found(p.best_collocations(spark.createDataFrame([], SCHEMA))) == []
    rows = [(1, None, None), (2, "", "en"), (3, " .. \n", "en"), (4, "one", "fr")]
    assert found(p.best_collocations(spark.createDataFrame(rows, SCHEMA))) == []
    rows = [(1, "same words here. " * 5, None)] * 4 + [(2, "very long " * 200_000, "en")]
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA + ", key string, n int")
    assert found(p.best_collocations(docs)) == brute(rows)
    # A count whose square passes 64 bits.
    squares = spark.range(1).select(p._exact(p.F.lit(4 * 10**9 + 1)).alias("a"))
    assert squares.selectExpr("CAST(a * a AS string)").first()[0] == str((4 * 10**9 + 1) ** 2)

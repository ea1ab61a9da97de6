"""Winnowed contamination against a search for every window."""

import random
import re

import pytest
from pyspark.sql import functions as F

from weftline.llm import decontamination

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
FOLDER = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(documents, items):
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(13, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(item)
    sizes = {len(x) for x in windows}
    out = []
    for doc, text in documents:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                items_of = windows.get(tuple(w[i : i + size]))
                if items_of:
                    hit.update(range(i, i + size))
                    found |= items_of
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), names, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def run(documents, items):
    df = decontamination.contamination(documents, items)
    return sorted(
        ((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in df.collect()),
        key=repr,
    )


def test_random_overlaps(spark):
    rng = random.Random(5)
    vocabulary = ["a", "b", "The", "é", "x1", "Ünder", "cat"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 4, 7, 13, 14, 30])))) for i in range(12)]
    items += [(3, items[3][1]), (None, "only this one has no name at all but it is longer than a window is"), (90, None), (91, "")]
    documents = []
    for d in range(60):
        text = rng.choices(vocabulary, k=rng.randrange(0, 40))
        for _ in range(rng.randrange(3)):
            piece = (rng.choice(items)[1] or "").split()
            start = rng.randrange(len(piece) + 1)
            text += piece[start : start + rng.randrange(30)] + rng.choices(vocabulary, k=3)
        documents.append((d, rng.choice([" ", ", ", "\n"]).join(text)))
    documents += [(1, documents[1][1]), (None, items[5][1]), (70, None), (71, ""), (72, "word " * 30_000)]
    docs = spark.createDataFrame(documents, "doc_id bigint, text string").withColumn("n_hit", F.lit("x"))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    assert run(docs, bench) == brute(documents, items)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two")], "doc_id bigint, text string")
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert run(docs, bench) == [(1, 2, 0, [], False)]
    assert run(docs.limit(0), bench) == []


@pytest.mark.parametrize("span", [1, 3, 5, 9, 13])
def test_every_window_holds_a_fingerprint(span):
    import pyarrow as pa

    from weftline.llm.word_hashes import LETTERS_DIGITS, blocks
    from weftline.llm.word_hashes import words as hashed

    rng = random.Random(span)
    texts = [" ".join(rng.choices("abcdefgh", k=n)) for n in (0, span, 40, span - 1, 200)]
    (block,) = blocks(pa.array(texts))
    found = hashed(block, LETTERS_DIGITS)
    places, _ = decontamination.winnow(found, span)
    run_length = min(decontamination.RUN, span)
    for row, text in enumerate(texts):
        first, n = found.bounds[row], len(text.split())
        for i in range(n - span + 1):
            inside = (places >= first + i) & (places + run_length <= first + i + span)
            assert inside.any()


def test_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    assert run(docs, bench) == brute(rows, items)

"""Languages by held-out accuracy, trigrams and bundles against plain Python."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from weftline.llm import language_id
from weftline.llm.folds import held_out
from weftline.llm.word_hashes import blocks

FOLDER = "/root/testdata/sf0.01"


def plain_trigrams(text):
    symbols = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text)
    symbols = " " + " ".join(symbols.split()) + " " if symbols.split() else " "
    return [symbols[i : i + 3] for i in range(len(symbols) - 2)]


def test_trigrams_and_bundles():
    texts = ["Ab c", "", "123 ...", "Éé-x", "中文字 text", "a", "Über  İx\n\nß", "q" * 300]
    (block,) = blocks(pa.array(texts))
    found = language_id.trigrams(block)
    sums = language_id.bundles(found, found.rows, len(texts))
    names = ["".join(chr(c) if c else " " for c in found.codes[t]) for t in found.table]
    for row, text in enumerate(texts):
        mine = [names[k] for k in found.numbers[found.rows == row]]
        assert sorted(mine) == sorted(plain_trigrams(text)), text
        assert found.lettered[row] == any(c.isalpha() for c in text)
        expected = np.zeros(language_id.DIMENSIONS)
        for t in mine:
            a, b, c = (language_id._letter(0 if x == " " else ord(x)) for x in t)
            expected += np.roll(a, 2) * np.roll(b, 1) * c
        assert np.allclose(sums[row], expected)


def test_large_alphabets_and_small_cells(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(chr(rng.randrange(0x4E00, 0x5200)) for _ in range(200)) for _ in range(5)]
    (block,) = blocks(pa.array(texts))
    found = language_id.trigrams(block)
    whole = language_id.bundles(found, found.rows, 5)
    monkeypatch.setattr(language_id, "CELLS", 1 << 14)
    assert np.allclose(language_id.bundles(found, found.rows, 5), whole)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("held", held_out(F.col("doc_id")))
    learned = language_id.learn(docs.where("NOT held"))
    found = docs.where("held").withColumn("found", language_id.identify(learned, spark)(F.col("text")))
    right, n = found.agg(F.sum((F.col("found.lang") == F.col("lang")).cast("int")), F.count(F.lit(1))).first()
    assert right / n > 0.97


def test_edge_cases(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "en"), (4, "", None), (5, "1 2 3", "en"), (None, "the dog", None), (1, "the cat and the dog", "en"), (6, "und die " * 20_000, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("found", F.lit(1))
    learned = language_id.learn(docs)
    assert learned.languages == ["de", "en"]
    got = docs.withColumn("r", language_id.identify(learned, spark)(F.col("text"))).collect()
    assert [r["r"]["lang"] for r in got] == ["en", "de", "und", "und", "und", "en", "en", "de"]
    assert all(0 <= r["r"]["score"] <= 1 for r in got)
    none = language_id.learn(docs.limit(0))
    blank = docs.withColumn("r", language_id.identify(none, spark)(F.col("text"))).collect()
    assert {(r["r"]["lang"], r["r"]["score"]) for r in blank} == {("und", 0.0)}
    assert docs.limit(0).withColumn("r", language_id.identify(learned, spark)(F.col("text"))).count() == 0


def test_held_out_fold(spark):
    import zlib

    df = spark.range(200).select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("h"))
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in df.collect())

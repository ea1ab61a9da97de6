"""Registered corpus queries against their SQL, and the pipeline against brute force."""

import glob
import math
import os
import re

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import test_decontamination, test_near_dup
from weftline.llm import oracles, queries, quality_rules, toxicity
from weftline.shared import Tables

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = queries.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    return repr(value)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    result = duck.execute(SQL[name])
    names = [c[0] for c in result.description]
    columns = sorted(df.columns)
    assert sorted(names) == columns
    expected = [dict(zip(names, row, strict=True)) for row in result.fetchall()]
    got = sorted([plain(r[c]) for c in columns] for r in df.collect())
    assert got == sorted([plain(r[c]) for c in columns] for r in expected)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - {"op13_neighbours"}))
def test_query_has_every_row(spark, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in documents}


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        if name == "toxicity":
            model = toxicity.train(docs, labels)
            scored = docs.withColumn("s", toxicity.score(model, spark)(F.col("text"))).collect()
            expected = {r["doc_id"] for r in scored if r["s"] < toxicity.THRESHOLD}
        elif name == "quality_rules":
            measures = quality_rules._measures(docs, "lang", F.xxhash64("text").alias("mark"))
            limits = quality_rules.learn_cutoffs(measures, labels, Tables(spark), together=True)
            judged = quality_rules._verdict(quality_rules._measures(docs, "lang"), limits, "stratum").collect()
            expected = {r["doc_id"] for r in judged if r["kept"]}
        elif name == "near_dup":
            expected = {r[0] for r in test_near_dup.brute(list(before.items()))[0] if r[3]}
        elif name == "decontamination":
            items = [(r["item_id"], r["text"]) for r in bench.collect()]
            expected = {r[0] for r in test_decontamination.brute(list(before.items()), items) if not r[4]}
        else:
            expected = set(before)
        kept[name] = {r["doc_id"] for r in after.select("doc_id").collect()}
        assert kept[name] == expected, name
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == columns
            docs = after
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = {}
    for r in after.collect():
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
    assert lengths == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in before.items()}
    run = {tuple(r) for r in corpus_pipeline.run(spark, FOLDER).select("doc_id", "piece", "start", "length", "ids_crc32").collect()}
    assert run == {tuple(r) for r in after.select("doc_id", "piece", "start", "length", "ids_crc32").collect()}


def test_core_does_not_import_this_subpackage():
    for path in glob.glob(os.path.join(os.path.dirname(queries.__file__), "..", "**", "*.py"), recursive=True):
        if f"{os.sep}llm{os.sep}" not in os.path.abspath(path):
            assert not re.search(r"(from|import) weftline\.llm", open(path, encoding="utf-8").read()), path


def written(spark, folder, docs, labels, items):
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint, label string, root int"
    spark.createDataFrame(docs, columns).coalesce(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").coalesce(1).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id string, text string").coalesce(1).write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Nulls, empty texts, repeated rows, no labels, and columns whose names the operators use."""
    def prose(i, n=80):
        return " ".join(f"w{(i * 37 + j * j) % 997}x{j}" for j in range(n))

    docs = [(i, prose(i), "en", "s", 5, "x", 1) for i in range(6)]
    docs += [docs[0], (7, docs[1][1], None, None, None, None, None), (None, prose(50), "en", "s", 1, "x", 1)]
    docs += [(8, None, "en", "s", 0, "x", 1), (9, "", "en", "s", 0, "x", 1), (10, prose(60, 30_000), "en", "s", 1, "x", 1)]
    folder = written(spark, tmp_path / "odd", docs, [(None, 1, 1), (1, None, None)], [("a", None), ("b", "")])
    kept = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in kept} == {0, 1, 2, 3, 4, 5, None, 10}
    assert sum(r["piece"] == 0 for r in kept) == 8 and max(r["length"] for r in kept) == 4096
    stage = dict(corpus_pipeline.STAGES)["quality_rules"]
    some = stage(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    assert some.columns == ["doc_id", "text", "lang", "source", "n_chars", "label", "root"] and some.count() == 10
    empty = written(spark, tmp_path / "empty", [], [], [])
    assert corpus_pipeline.run(spark, empty).collect() == []

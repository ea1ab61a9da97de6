"""The corpus pipeline: documents in, packed sequences of clean documents out.

Each stage is given what the stage before kept, written and read again as Parquet, and applies
one operator to all of it. All but the last return the columns of documents.

Defined results: null and empty texts are not toxic, fail the quality rules' base of 50 words and
so go there; rows without doc_id are judged like others; of repeated rows one stays; without
labels nothing is learned, so only the base rule rejects; without benchmark items nothing is
contaminated; an empty table gives an empty table; further columns go with their rows up to the
last stage, which returns its own.
"""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import decontamination, near_dup, packing, quality_rules, toxicity
from weftline.llm.settings import TOKENIZER
from weftline.shared import Tables
from weftline.sources.tables import table


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    score = toxicity.score(model, spark)
    return docs.where(toxicity.predicted(score(F.col("text"))) == 0)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"), together=True)


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.one_of_each(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    definition = Path(public_tokenizers.path(TOKENIZER)).read_text(encoding="utf-8")
    pieces = packing.pack(docs, definition)
    return pieces.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", not_toxic),
    ("quality_rules", good_quality),
    ("near_dup", no_near_duplicates),
    ("decontamination", no_benchmark),
    ("packing", packed),
]

# The stages rest on a learned model, a search for components and a tokenizer, which SQL cannot
# express; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Tables(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        kept = tables.cut(stage(spark, docs, sf_dir), name)
        tables.drop(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)

"""The registered queries: each operator over its whole table, in the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import (
    conversation_repair,
    cotraining,
    decontamination,
    language_id,
    licenses,
    near_dup,
    neighbours,
    packing,
    phrases,
    quality_rules,
    sharding,
    toxicity,
    url_filter,
)
from weftline.llm.folds import held_out
from weftline.llm.settings import SHARDS, TOKENIZER, URL_RULES
from weftline.sources.tables import table


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    measures = [F.col("measures")[m].alias(m) for m in quality_rules.MEASURES]
    return judged.select("doc_id", *measures, "base_failed", "kept")


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = docs.select("doc_id", licenses.scan(spark)(F.col("text")).alias("found"))
    return found.select("doc_id", "found.license", "found.dice", "found.line")


def op2_license_passages(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = docs.select("doc_id", licenses.passages(spark)(F.col("text")).alias("found"))
    return found.select("doc_id", *[f"found.{c}" for c in ("license", "dice", "line", "last_line", "others")])


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    sharded = sharding.shard_documents(table(spark, folder, "documents"), SHARDS)
    return sharded.select(
        "document.doc_id",
        "size",
        F.crc32(F.coalesce("document.text", F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_cotraining(spark: SparkSession, folder: str) -> DataFrame:
    return cotraining.co_train(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_near_dup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, folder, "documents"))


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", held_out(F.col("doc_id")))
    learned = language_id.learn(docs.where(~F.col("held_out")))
    found = docs.withColumn("found", language_id.identify(learned, spark)(F.col("text")))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    scored = docs.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        toxicity.score(model, spark)(F.col("text")).alias("score"),
    )
    return scored.withColumn("predicted", toxicity.predicted(F.col("score")))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    definition = Path(public_tokenizers.path(TOKENIZER)).read_text(encoding="utf-8")
    packed = packing.pack(table(spark, folder, "documents"), definition)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, folder, "pages").select("page_id", "url")
    judged = url_filter.judge_urls(pages, rules)
    return judged.select("page.page_id", "host", "path", "rule", "verdict")


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.best_collocations(table(spark, folder, "documents"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    return conversation_repair.repair(conversation_repair.damaged(turns), turns)


def op13_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors, F.col("vec_id") % 20 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_quality_rules,
        op2_license_scan,
        op2_license_passages,
        op3_sharding,
        op4_cotraining,
        op5_near_dup,
        op6_language_id,
        op7_toxicity,
        op8_decontamination,
        op9_packing,
        op10_url_filter,
        op11_phrases,
        op12_conversation_repair,
        op13_neighbours,
    ]
    return {f.__name__: f for f in found}

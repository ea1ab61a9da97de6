"""Rows of documents picked by doc_id and a hash of the text.

The picked rows come as a written table, so Spark knows its size: a small one is broadcast, for
a large one both sides are sorted by the key, which adaptive execution splits where it is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _picked(docs: DataFrame, picked: DataFrame, how: str) -> DataFrame:
    """``picked`` is ``(doc_id, mark)``, distinct, with ``mark`` = xxhash64 of the text."""
    keys = picked.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"))
    same = docs["doc_id"].eqNullSafe(keys["_id"]) & (F.xxhash64(docs["text"]) == keys["_mark"])
    return docs.join(keys, same, how)


def without_rows(docs: DataFrame, picked: DataFrame) -> DataFrame:
    return _picked(docs, picked, "left_anti")


def with_rows(docs: DataFrame, picked: DataFrame) -> DataFrame:
    return _picked(docs, picked, "left_semi")

"""Words of texts and their vowels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions.scalars import WORD_GAP, vowel_count


def words(
    df: DataFrame, text: str = "value", keep: Sequence[str] = (), distinct: bool = False
) -> DataFrame:
    """One row per word; repeated words are kept unless ``distinct`` within their text."""
    parts = F.split(text, WORD_GAP)
    found = F.array_distinct(parts) if distinct else parts
    # The filter runs after the explode: there it is generated code instead of a lambda.
    return df.select(*keep, F.explode(found).alias("word")).where(F.col("word") != "")


def vowel_counts(word_rows: DataFrame) -> DataFrame:
    return word_rows.withColumn("vowels", vowel_count(F.col("word")))


def most_vowels(word_rows: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` words with most vowels, ties by word: each task keeps k rows, no full sort."""
    return vowel_counts(word_rows).orderBy(F.desc("vowels"), "word").limit(k)

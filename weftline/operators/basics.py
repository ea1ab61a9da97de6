"""Counts, sums, averages, distinct values, set operations, sampling and first rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def total(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.sum(column).alias("total"))


def average(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.avg(column).alias("average"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def count_distinct(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.countDistinct(column).alias("n_distinct"))


def distinct_average(df: DataFrame, column: str) -> DataFrame:
    """Sum, count and average over the distinct values, in one pass over them."""
    value = F.col(column)
    return distinct_values(df, column).agg(
        F.sum(value).alias("distinct_sum"),
        F.count(value).alias("distinct_count"),
        F.avg(value).alias("distinct_average"),
    )


def bag_union(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both, duplicates kept."""
    return first.unionByName(second)


def intersection(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows found in both, without duplicates.

    One grouping of both sides instead of a join: rows combine before the one shuffle, so a
    value that fills much of a side crosses it once per task, and NULLs compare as equal.
    """
    sides = first.withColumn("_in", F.lit(1)).unionByName(second.withColumn("_in", F.lit(2)))
    seen = sides.groupBy(*first.columns).agg(F.min("_in").alias("_a"), F.max("_in").alias("_b"))
    return seen.where("_a = 1 AND _b = 2").select(*first.columns)


def first_rows(df: DataFrame, order_by: Sequence[str], k: int) -> DataFrame:
    return df.orderBy(*order_by).limit(k)


def bernoulli_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def _seeded(columns: Sequence[str], seed: int) -> list:
    return [F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]]


def hash_threshold(fraction: float) -> int:
    return int(fraction * (1 << 32))


def hash_sample(df: DataFrame, key: Sequence[str], fraction: float, seed: int) -> DataFrame:
    """Bernoulli sample that picks the same rows on every run and partitioning."""
    bucket = F.conv(F.substring(F.md5(F.concat_ws(":", *_seeded(key, seed))), 1, 8), 16, 10)
    return df.where(bucket.cast("long") < F.lit(hash_threshold(fraction)))


def exact_sample(df: DataFrame, key: Sequence[str], k: int, seed: int) -> DataFrame:
    """``k`` rows without replacement: the lowest seeded hashes, ties by key."""
    rank = F.md5(F.concat_ws(":", *_seeded(key, seed)))
    return df.orderBy(rank, *key).limit(k)

"""Selection of rows, columns and their intersection from a matrix ``(r, c, v)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dense_to_entries(rows: DataFrame, row_id: str, vector: str) -> DataFrame:
    """Dense rows as one entry per cell; columns count from 0, zeros are kept."""
    cells = rows.select(F.col(row_id).alias("r"), F.posexplode(vector).alias("c", "v"))
    return cells.select("r", F.col("c").cast("long").alias("c"), F.col("v").cast("double"))


def drop_zeros(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("v") != 0)


def _positions(index: Column, chosen: Sequence[int]) -> Column:
    """The places at which ``index`` stands in the short list ``chosen``."""
    places: dict[int, list[int]] = {}
    for place, value in enumerate(chosen):
        places.setdefault(value, []).append(place)
    cases = F.array().cast("array<int>")
    for value, at in places.items():
        cases = F.when(index == value, F.array(*[F.lit(p) for p in at])).otherwise(cases)
    return cases


def select_rows(entries: DataFrame, rows: Sequence[int]) -> DataFrame:
    """``(pos, r, c, v)`` for the listed rows; a repeated row appears at each of its places.

    The list is a filter on ``r`` that reaches the scan, not a join.
    """
    kept = entries.where(F.col("r").isin(*rows))
    return kept.select(F.explode(_positions(F.col("r"), rows)).alias("pos"), "r", "c", "v")


def select_columns(entries: DataFrame, columns: Sequence[int]) -> DataFrame:
    """``(pos, r, c, v)`` for the listed columns; the list may repeat."""
    kept = entries.where(F.col("c").isin(*columns))
    return kept.select(F.explode(_positions(F.col("c"), columns)).alias("pos"), "r", "c", "v")


def intersection(entries: DataFrame, rows: Sequence[int], columns: Sequence[int]) -> DataFrame:
    """``(row_pos, col_pos, r, c, v)``: the cells where listed rows and columns meet."""
    kept = entries.where(F.col("r").isin(*rows) & F.col("c").isin(*columns))
    by_row = kept.select(F.explode(_positions(F.col("r"), rows)).alias("row_pos"), "r", "c", "v")
    col_pos = F.explode(_positions(F.col("c"), columns)).alias("col_pos")
    return by_row.select("row_pos", col_pos, "r", "c", "v")


def select_rows_by_table(entries: DataFrame, index: DataFrame) -> DataFrame:
    """As ``select_rows`` for a long index table ``(pos, r)``; Spark picks the join by size."""
    return entries.join(index, "r").select("pos", "r", "c", "v")


def select_columns_by_table(entries: DataFrame, index: DataFrame) -> DataFrame:
    """As ``select_columns`` for a long index table ``(pos, c)``."""
    return entries.join(index, "c").select("pos", "r", "c", "v")

"""Consecutive numbers in a given order without sending all rows to one task.

Rows are range-partitioned on the full order (ties cannot pile up as long as the order is
unique), stamped with partition and place, and written once. What crosses partitions is one
row per partition: counts become offsets and are broadcast back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.shared import cut

# monotonically_increasing_id() keeps the partition number above bit 33.
_PLACE_BITS = 33
_PLACE_MASK = (1 << _PLACE_BITS) - 1


def _stamped(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    ranged = df.repartitionByRange(*[F.col(c) for c in order_by]).sortWithinPartitions(*order_by)
    stamp = F.monotonically_increasing_id()
    placed = cut(ranged.withColumn("_stamp", stamp), "ordered")
    return placed.withColumns(
        {
            "_part": F.shiftright("_stamp", _PLACE_BITS),
            "_place": F.col("_stamp").bitwiseAND(F.lit(_PLACE_MASK)),
        }
    ).drop("_stamp")


def ordered_index(df: DataFrame, order_by: Sequence[str], name: str = "idx") -> DataFrame:
    """Add 0-based ``name`` in the order of ``order_by``, which must be unique."""
    rows = _stamped(df, order_by)
    # One row per partition, so this unpartitioned window and the broadcast stay small.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        rows.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_place"))
        .drop("_part", "_place", "_offset")
    )


def keyed_index(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], name: str = "pos"
) -> DataFrame:
    """Add 0-based ``name`` counting the rows of each key in the order of ``order_by``.

    ``keys`` plus ``order_by`` must be unique. A key may span many partitions: only the rows it
    already has in earlier partitions are carried over, one number per partition.
    """
    rows = _stamped(df, [*keys, *order_by]).withColumn("_key", F.struct(*keys))
    ends = rows.groupBy("_part").agg(F.min("_key").alias("_head"), F.max("_key").alias("_tail"))
    tails = (
        rows.select("_part", "_key")
        .join(F.broadcast(ends), "_part")
        .where(F.col("_key") == F.col("_tail"))
        .groupBy("_part", "_head", "_tail")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    run = Window.partitionBy("_tail").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    by_part = Window.orderBy("_part")
    carries = (
        tails.withColumn("_so_far", F.sum("_rows").over(run))
        .withColumn("_last", F.lag("_tail").over(by_part))
        .withColumn("_last_rows", F.lag("_so_far").over(by_part))
        .select(
            "_part",
            F.col("_head").alias("_key"),
            F.when(F.col("_last") == F.col("_head"), F.col("_last_rows")).alias("_carry"),
        )
        .where(F.col("_carry").isNotNull())
    )
    # Each window group lies within one written partition, whatever the size of the key.
    inside = Window.partitionBy("_part", "_key")
    return (
        rows.withColumn("_first", F.min("_place").over(inside))
        .join(F.broadcast(carries), ["_part", "_key"], "left")
        .withColumn(name, F.col("_place") - F.col("_first") + F.coalesce("_carry", F.lit(0)))
        .drop("_part", "_place", "_key", "_first", "_carry")
    )

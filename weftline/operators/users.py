"""Plays of items by users: alias resolution, the user-item matrix, similarity of users.

Plays are rows ``(user_id, item_id, cnt)`` plus the columns that give their order of arrival.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.lookup import lookup
from weftline.operators.set_neighbours import similar_sets


def resolve_aliases(plays: DataFrame, aliases: DataFrame) -> DataFrame:
    """Replace aliased items by their good id, one hop only; other items stay.

    ``aliases`` is ``(bad_id, good_id)`` with one row per bad id (see ``alias_table``). It is
    written first, so that a small one leaves the plays where they are.
    """
    table = aliases.select(F.col("bad_id").alias("item_id"), "good_id")
    joined = lookup(plays, table, ["item_id"], write=True)
    return joined.withColumn("item_id", F.coalesce("good_id", "item_id")).drop("good_id")


def utility_matrix(plays: DataFrame, arrival: Sequence[str], mode: str = "last") -> DataFrame:
    """``(user_id, item_id, cnt)``: the last count to arrive, or the sum with ``mode='sum'``.

    Of counts that arrive together the largest is last. Kept in long form: a row per user would
    gather all items of a busy user in one value.
    """
    if mode == "last":
        cnt = F.max(F.struct(*arrival, "cnt"))["cnt"]
    elif mode == "sum":
        cnt = F.sum("cnt")
    else:
        raise ValueError("mode is 'last' or 'sum'")
    return plays.groupBy("user_id", "item_id").agg(cnt.alias("cnt"))


def user_similarity(matrix: DataFrame, user1: int, user2: int) -> DataFrame:
    """Common items of two users, their ratio to the items of only one, and the Jaccard index.

    No row unless both users exist and differ. ``ratio`` is NULL for identical item sets.
    """
    if user1 == user2:
        pair = matrix.where(F.lit(False))
    else:
        pair = matrix.where(F.col("user_id").isin(user1, user2))
    per_item = pair.groupBy("item_id").agg(
        F.max(F.when(F.col("user_id") == user1, 1).otherwise(0)).alias("in1"),
        F.max(F.when(F.col("user_id") == user2, 1).otherwise(0)).alias("in2"),
    )
    counts = per_item.agg(
        F.sum("in1").alias("n1"),
        F.sum("in2").alias("n2"),
        F.sum(F.col("in1") * F.col("in2")).alias("common"),
    ).where((F.col("n1") > 0) & (F.col("n2") > 0))
    only_one = F.col("n1") + F.col("n2") - 2 * F.col("common")
    return counts.select(
        F.lit(user1).cast("long").alias("user1"),
        F.lit(user2).cast("long").alias("user2"),
        "common",
        F.try_divide(F.col("common").cast("double"), only_one).alias("ratio"),
        (F.col("common") / (F.col("n1") + F.col("n2") - F.col("common"))).alias("jaccard"),
    )


def nearest_users(matrix: DataFrame, k: int) -> DataFrame:
    """``(user_id, rank, other_id, common, ratio, jaccard)``: the k most similar users of each.

    Only users with a common item count; ties go to the lowest id. ``ratio`` and ``jaccard`` give
    the same order.
    """
    found = similar_sets(matrix.select(F.col("user_id").alias("member"), F.col("item_id").alias("element")), k)
    only_one = F.col("n") + F.col("m") - 2 * F.col("common")
    return found.select(
        F.col("member").alias("user_id"),
        "rank",
        F.col("other").alias("other_id"),
        "common",
        F.try_divide(F.col("common").cast("double"), only_one).alias("ratio"),
        (F.col("common") / (F.col("n") + F.col("m") - F.col("common"))).alias("jaccard"),
    )

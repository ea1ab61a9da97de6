"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.shared import Tables


def components(edges: DataFrame, tables: Tables) -> DataFrame:
    """``(node, root)``: every node of edges ``(a, b)`` with the smallest node it reaches.

    Alternates two steps until the edges are stars: large-star hangs each node's larger
    neighbours on its least one, small-star does so with its smaller neighbours. Chains halve,
    so rounds grow with the logarithm of the longest path. Minima combine before they shuffle,
    and a node of any degree is only ever a key of joins, which adaptive execution can split.
    """
    def canonical(df: DataFrame) -> DataFrame:
        ends = df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        return ends.distinct()

    def starred(now: DataFrame) -> DataFrame:
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        middle = canonical(large)
        below = middle.groupBy("a").agg(F.min("b").alias("m"))
        small = middle.join(below, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return canonical(small.unionByName(below.select("a", F.col("m").alias("b"))))

    now = tables.cut(canonical(edges), "edges", edges.count())
    while True:
        n = now.count()
        after = tables.cut(starred(now), "edges", 2 * n)
        # Both are sets, so as many rows and none new means that nothing changed.
        same = after.count() == n and after.join(now, ["a", "b"], "left_anti").isEmpty()
        tables.drop(now)
        now = after
        if same:
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    own = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    stars = tables.cut(roots.unionByName(own), "roots", 2 * n)
    tables.drop(now)
    return stars

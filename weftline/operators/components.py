"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.shared import Tables


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)``: every node of edges ``(a, b)`` with the smallest node it reaches.

    Nodes are of any ordered type. Two steps take turns until the edges are stars: all larger
    neighbours of a node are hung on the least of its neighbours and itself, then its smaller
    ones are. Chains halve, so rounds grow with the logarithm of the longest path. Minima are
    written before they are joined, so that both sides of a join are plain tables, of which
    adaptive execution can split the partition of a node with very many edges.
    """
    tables = Tables(edges.sparkSession)

    def canonical(df: DataFrame) -> DataFrame:
        ends = df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        return ends.distinct()

    def hung(df: DataFrame, least: DataFrame) -> DataFrame:
        return df.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))

    now = tables.cut(canonical(edges.select("a", "b")), "edges")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = tables.cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        middle = tables.cut(canonical(hung(both.where("b > a"), least)), "edges")
        below = tables.cut(middle.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = hung(middle, below).unionByName(below.select("a", F.col("m").alias("b")))
        after = tables.cut(canonical(small), "edges")
        # Both are sets, so as many rows and none new means that nothing changed.
        same = after.count() == now.count() and after.join(now, ["a", "b"], "left_anti").isEmpty()
        tables.drop(now, least, middle, below)
        now = after
        if same:
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())

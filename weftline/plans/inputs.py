"""The operators' inputs, taken from the tables of a data folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.scalars import WORD_GAP
from weftline.operators import expwindow
from weftline.operators.lookup import lookup
from weftline.operators.minhash import word_number
from weftline.sources.tables import table

ARRIVAL = ["o_orderdate", "o_orderkey", "l_linenumber"]


def points(spark: SparkSession, folder: str) -> DataFrame:
    """``(id, v)`` from the embeddings."""
    v = F.col("embedding").cast("array<double>").alias("v")
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), v)


def first_centres(spark: SparkSession, folder: str, k: int) -> list[list[float]]:
    rows = points(spark, folder).orderBy("id").limit(k).collect()
    return [list(r["v"]) for r in rows]


def mean_vectors(rows: DataFrame, by: str) -> DataFrame:
    """``(id, v)``: the element-wise mean per value of ``by``."""
    cells = rows.select(F.col(by).alias("id"), F.posexplode("v").alias("dim", "x"))
    means = cells.groupBy("id", "dim").agg(F.avg("x").alias("x"))
    ordered = F.sort_array(F.collect_list(F.struct("dim", "x")))
    return means.groupBy("id").agg(ordered.alias("cells")).select("id", F.col("cells.x").alias("v"))


def label_centres(spark: SparkSession, folder: str) -> DataFrame:
    v = F.col("embedding").cast("array<double>").alias("v")
    return mean_vectors(table(spark, folder, "embeddings").select("label", v), "label")


def plays(spark: SparkSession, folder: str) -> DataFrame:
    """``(user_id, item_id, cnt)`` and the columns of arrival, from order lines.

    Both sides are large; a hot order is split by adaptive execution's skew join.
    """
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        "l_linenumber",
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").cast("long").alias("cnt"),
    )
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderdate", F.col("o_custkey").alias("user_id")
    )
    return lines.join(orders, "o_orderkey").select("user_id", "item_id", "cnt", *ARRIVAL)


def aliases(spark: SparkSession, folder: str) -> DataFrame:
    """``(bad_id, good_id)``: parts stand for the lowest key of the same brand and type."""
    parts = table(spark, folder, "part").select("p_partkey", "p_brand", "p_type")
    lowest = parts.groupBy("p_brand", "p_type").agg(F.min("p_partkey").alias("good_id"))
    named = lookup(parts, lowest, ["p_brand", "p_type"], "inner", write=True)
    return named.where(F.col("p_partkey") != F.col("good_id")).select(
        F.col("p_partkey").alias("bad_id"), "good_id"
    )


def word_sets(spark: SparkSession, folder: str) -> DataFrame:
    """``(set_id, element)``: documents as bags of numbered lower-case words.

    Minima do not mind repeated words, so none are dropped. A document without words keeps one
    row, whose element is NULL.
    """
    docs = table(spark, folder, "documents").select("doc_id", F.lower("text").alias("text"))
    parts = F.split(F.coalesce("text", F.lit("")), WORD_GAP)
    # Blanks at a text's ends leave empty parts, which like the NULL count for nothing.
    each = docs.select("doc_id", F.explode(parts).alias("word"))
    element = F.when(F.col("word") != "", word_number(F.col("word")))
    return each.select(F.col("doc_id").alias("set_id"), element.alias("element"))


def purchase_bit() -> Column:
    """An event without a type is no purchase."""
    return F.coalesce(F.col("event_type") == "purchase", F.lit(False))


def bits(spark: SparkSession, folder: str) -> DataFrame:
    """``(key, pos, bit)``: per user and in order of time, is the event a purchase?"""
    events = table(spark, folder, "events")
    return expwindow.number_bits(events, "user_id", ["ts", "event_id"], purchase_bit())


def all_bits(spark: SparkSession, folder: str) -> DataFrame:
    """The same for all events as one stream, whose key is 0."""
    events = table(spark, folder, "events").withColumn("stream", F.lit(0).cast("long"))
    return expwindow.number_bits(events, "stream", ["ts", "event_id"], purchase_bit())


def samples(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as ``(x, y)``: quantity and price, scaled to about [0, 1]."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        (F.col("l_quantity") / 50).alias("x"),
        (F.col("l_extendedprice") / 100000).alias("y"),
    )

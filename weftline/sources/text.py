"""Text readers and writers.

Readers keep lines they cannot parse: the values are NULL and ``_corrupt`` holds the line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions.scalars import WORD_GAP
from weftline.shared import cut


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def stream_lines(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.text(folder)


def _strip(line: Column) -> Column:
    return F.regexp_replace(line, rf"^{WORD_GAP}|{WORD_GAP}$", "")


def _quarantined(
    parsed: DataFrame, line: Column, ok: Column, columns: list[str], keep: Sequence[str] = ()
) -> DataFrame:
    kept = [F.when(ok, F.col(c)).alias(c) for c in columns]
    return parsed.select(*keep, *kept, F.when(~ok, line).alias("_corrupt"))


def _in_order(path: Column) -> Column:
    """A path with its numbers padded, so that part 100000 comes after part 99999."""
    padded = F.regexp_replace(path, r"(\d+)", "0" * 20 + "$1")
    return F.regexp_replace(padded, r"0*(\d{20})(?!\d)", "$1")


def read_ints(spark: SparkSession, path: str) -> DataFrame:
    """``(value, _corrupt)``: one integer per line."""
    lines = read_lines(spark, path).withColumnRenamed("value", "line")
    parsed = lines.withColumn("value", _strip(F.col("line")).try_cast("long"))
    return _quarantined(parsed, F.col("line"), F.col("value").isNotNull(), ["value"])


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """``(v, _corrupt)``: numbers parted by single blanks."""
    lines = read_lines(spark, path).withColumnRenamed("value", "line")
    numbers = F.transform(F.split("line", " "), lambda x: x.try_cast("double"))
    parsed = lines.withColumn("v", numbers)
    return _quarantined(parsed, F.col("line"), ~F.exists("v", lambda x: x.isNull()), ["v"])


def vector_lines(df: DataFrame, vector: str = "v") -> DataFrame:
    """Each vector as a line of numbers parted by blanks."""
    text = F.transform(vector, lambda x: x.cast("string"))
    return df.select(F.concat_ws(" ", text).alias("value"))


def write_vectors(df: DataFrame, path: str, vector: str = "v") -> None:
    vector_lines(df, vector).write.text(path)


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    """``(bad_id, good_id, _corrupt)`` from two fields parted by a tab."""
    return _alias_fields(read_lines(spark, path).withColumnRenamed("value", "line"))


def _alias_fields(lines: DataFrame, *keep: str) -> DataFrame:
    fields = F.split("line", "\t")
    parsed = lines.select(
        "line",
        *keep,
        F.size(fields).alias("n"),
        _strip(F.get(fields, 0)).try_cast("long").alias("bad_id"),
        _strip(F.get(fields, 1)).try_cast("long").alias("good_id"),
    )
    ok = (F.col("n") == 2) & F.col("bad_id").isNotNull() & F.col("good_id").isNotNull()
    return _quarantined(parsed, F.col("line"), ok, ["bad_id", "good_id"], keep)


def read_alias_table(spark: SparkSession, path: str) -> DataFrame:
    """``(bad_id, good_id)``: one row per bad id, by its last line in file and line order."""
    lines = numbered_lines(spark, path)
    return alias_table(_alias_fields(lines.withColumnRenamed("value", "line"), "line_no"), "line_no")


def alias_table(numbered: DataFrame, order: str) -> DataFrame:
    """One row per bad id: the last by ``order``."""
    sound = numbered.where(F.col("bad_id").isNotNull())
    return sound.groupBy("bad_id").agg(F.max_by("good_id", order).alias("good_id"))


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    """``(user_id, item_id, cnt, _corrupt)`` from three integers parted by blanks."""
    lines = read_lines(spark, path).withColumnRenamed("value", "line")
    fields = F.split(_strip(F.col("line")), WORD_GAP)
    names = ["user_id", "item_id", "cnt"]
    values = [F.get(fields, i).try_cast("long").alias(n) for i, n in enumerate(names)]
    parsed = lines.select("line", F.size(fields).alias("n"), *values)
    ok = F.col("n") == 3
    for n in names:
        ok = ok & F.col(n).isNotNull()
    return _quarantined(parsed, F.col("line"), ok, names)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line_no, value)``: lines counted from 0 across all files in path order.

    Numbers in paths count as numbers. Each file split keeps its lines in order. They are
    stamped while read and written once; the offsets are one row per split, written too, so
    Spark broadcasts them by their size unless there are very many splits.
    """
    stamped = cut(
        read_lines(spark, path).select(
            "value",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_stamp"),
        ),
        "lines",
    )
    splits = stamped.groupBy("_file", "_start").agg(
        F.count(F.lit(1)).alias("_lines"), F.min("_stamp").alias("_first")
    )
    before = Window.orderBy(_in_order(F.col("_file")), "_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(
        "_file", "_start", "_first", F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_at")
    )
    line_no = F.col("_at") + F.col("_stamp") - F.col("_first")
    return stamped.join(cut(offsets, "offsets"), ["_file", "_start"]).select(line_no.alias("line_no"), "value")


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """``(r, c, v, _corrupt)`` from a dense text matrix.

    Rows and columns count from 0 and zeros are kept. A blank line gives no entry but still
    counts as a row. A cell that is not a number has NULL ``v`` and its text in ``_corrupt``.
    """
    lines = numbered_lines(spark, path)
    fields = F.filter(F.split("value", WORD_GAP), lambda x: x != "")
    cells = lines.select(F.col("line_no").alias("r"), F.posexplode(fields).alias("c", "text"))
    v = F.col("text").try_cast("double")
    return cells.select(
        "r",
        F.col("c").cast("long").alias("c"),
        v.alias("v"),
        F.when(v.isNull(), F.col("text")).alias("_corrupt"),
    )

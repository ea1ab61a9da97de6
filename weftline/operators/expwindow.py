"""Counts of ones among the most recent bits, exact and from exponential-window blocks.

Bits are rows ``(key, pos, bit)``, ``pos`` counting each key's bits from 0. Nothing replays
the stream: which blocks are live after n bits follows from n and the window width alone,
and a block's ones are a sum over an aligned range of positions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.scalars import relative_error
from weftline.operators.lookup import lookup
from weftline.operators.numbering import keyed_index
from weftline.shared import cut

CHUNK = 1 << 16


def number_bits(df: DataFrame, key: str, order_by: Sequence[str], bit: Column) -> DataFrame:
    """``(key, pos, bit)`` from events; one key may hold any share of them.

    Written once, as every window operator reads its bits more than once.
    """
    rows = df.select(F.col(key).alias("key"), *order_by, bit.cast("int").alias("bit"))
    return cut(keyed_index(rows, ["key"], order_by).select("key", "pos", "bit"), "bits")


def ones_exact(bits: DataFrame, k: int) -> DataFrame:
    """``(key, n, ones)``: after each of the n bits, the ones among the last k of them.

    Windows run over chunks of positions, each with the k - 1 bits before it, so a long key
    is many window groups.
    """
    size = max(k, CHUNK)
    own = F.expr(f"pos div {size}")
    reaches_on = F.col("pos") % size >= size - (k - 1)
    chunks = F.when(reaches_on, F.array(own, own + 1)).otherwise(F.array(own))
    last_k = Window.partitionBy("key", "chunk").orderBy("pos").rowsBetween(-(k - 1), 0)
    return (
        bits.withColumn("chunk", F.explode(chunks))
        .withColumn("ones", F.sum("bit").over(last_k))
        .where(F.col("chunk") == own)
        .select("key", (F.col("pos") + 1).alias("n"), "ones")
    )


def top_level(width: int) -> int:
    """The level of the largest blocks a window of ``width`` bits keeps."""
    level = 0
    while 3 * 2**level - 2 < width:
        level += 1
    return level


def _shift(value: Column, by: Column) -> Column:
    return F.call_function("shiftright", value, by)


def block_sums(bits: DataFrame, width: int) -> DataFrame:
    """``(key, level, block, ones)``: ones in positions block * 2^level and on, 2^level long."""
    single = bits.selectExpr("key", "0 AS level", "pos AS block", "CAST(bit AS BIGINT) AS ones")
    top = top_level(width)
    if top == 0:
        return single
    levels = F.explode(F.sequence(F.lit(1), F.lit(top))).alias("level")
    longer = (
        bits.select("key", "pos", "bit", levels)
        .groupBy("key", "level", _shift(F.col("pos"), F.col("level")).alias("block"))
        .agg(F.sum("bit").alias("ones"))
    )
    return single.unionByName(longer)


def live_blocks(steps: DataFrame, width: int) -> DataFrame:
    """``(key, n, level, block)``: the blocks kept after n bits, for each step ``(key, n)``.

    With m = floor((n + 1) / 2^level) - 1, a level below the top keeps its last one or two
    blocks before m (one if m is odd); the top keeps all that reach into the window.
    """
    top = top_level(width)
    n, level = F.col("n"), F.col("level")
    leveled = steps.select("key", "n", F.explode(F.sequence(F.lit(0), F.lit(top))).alias("level"))
    counted = leveled.withColumn("m", _shift(n + 1, level) - 1).where(F.col("m") > 0)
    lowest = F.when(level < top, F.col("m") - 2 + F.col("m") % 2).otherwise(
        F.greatest(F.lit(0).cast("long"), F.shiftright(n - width, top))
    )
    blocks = F.explode(F.sequence("lowest", F.col("m") - 1)).alias("block")
    spans = counted.withColumn("lowest", lowest).where(F.col("lowest") < F.col("m"))
    return spans.select("key", "n", "level", blocks)


def _start(block: str = "block") -> Column:
    return F.call_function("shiftleft", F.col(block), F.col("level"))


def _end(block: str = "block") -> Column:
    return F.call_function("shiftleft", F.col(block) + 1, F.col("level"))


def final_blocks(bits: DataFrame, width: int) -> DataFrame:
    """``(key, n, level, block, first_pos, last_pos, ones)``: the blocks live at each key's end."""
    last = bits.groupBy("key").agg((F.max("pos") + 1).alias("n"))
    # Only the bits a live block can reach are summed.
    reach = width + 2 ** (top_level(width) + 1)
    recent = lookup(bits, last, ["key"], "inner").where(
        F.col("pos") >= F.col("n") - reach
    )
    live = live_blocks(last, width)
    ends = [_start().alias("first_pos"), (_end() - 1).alias("last_pos")]
    found = live.join(block_sums(recent, width), ["key", "level", "block"])
    return found.select("key", "n", "level", "block", *ends, "ones")


def estimates(bits: DataFrame, width: int, k: int, every: int = 10) -> DataFrame:
    """``(key, n, estimate)``: every so many bits, the estimated ones among the last k.

    Blocks inside the last k bits count in full, the one that straddles them by half.
    """
    if not 1 <= k <= width:
        raise ValueError("k must lie between 1 and the window width")
    steps = bits.select("key", (F.col("pos") + 1).alias("n")).where(F.col("n") % every == 0)
    n = F.col("n")
    weight = F.when(n - _start() <= k, 1.0).when(n - _end() < k, 0.5)
    weighed = live_blocks(steps, width).withColumn("weight", weight).where("weight IS NOT NULL")
    joined = weighed.join(block_sums(bits, width), ["key", "level", "block"])
    part = F.col("weight") * F.col("ones")
    return joined.groupBy("key", "n").agg(F.sum(part).alias("estimate"))


def error_report(bits: DataFrame, width: int, k: int, every: int = 10) -> DataFrame:
    """Estimate, actual count, signed and relative error (NULL at 0) at every report step."""
    actual = ones_exact(bits, k).where(F.col("n") % every == 0)
    both = estimates(bits, width, k, every).join(actual, ["key", "n"])
    return both.select(
        "key",
        "n",
        F.col("ones").alias("actual"),
        "estimate",
        (F.col("estimate") - F.col("ones")).alias("absolute_error"),
        relative_error(F.col("estimate"), F.col("ones")).alias("relative_error"),
    )

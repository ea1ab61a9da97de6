"""Shards of near equal bytes by histogram sort.

Documents are ordered by (hash of text, hash of row), so equal texts lie together and no key is
hot. Splitters of that order are found without sorting: each round counts the exact bytes below
candidate boundaries, which are the ends of 2^12 equal ranges of the key, then looks closer
only into the ranges that hold a target. A round is one grouping of a narrow table of keys and
sizes; what reaches the driver is at most 2^12 counts for each splitter still open. Two rounds
are the rule, more where one text makes up much of the corpus. Then the documents cross the
network once, to the cells they are numbered in.

Rows equal in every column are one point of the order. If such a point outweighs the tolerance,
the rows are stamped with a number each and written, and the order is (text, number).

Defined results: a null text has size 8; ties keep to one shard or adjoin; an empty table gives
an empty table; any further columns come along inside ``document``.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.shared import Tables

ROUND_BITS = 12
# Largest miss of a splitter, as a share of a shard's bytes.
TOLERANCE = 0.0005
CELLS_PER_PARTITION = 4

_LOW = -(1 << 63)


class Boundary(NamedTuple):
    """Keys at or above (high, low) are past it; ``None`` lies past every key."""

    high: int | None
    low: int = _LOW


def size_of(text: Column) -> Column:
    """UTF-8 bytes of the text plus 8."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def _hashable(kind: T.DataType) -> bool:
    return "map<" not in kind.simpleString() and "variant" not in kind.simpleString()


def _prefix(key: str, bits: int) -> Column:
    """The first ``bits`` of a signed key, in the key's order, as an unsigned number."""
    return F.shiftrightunsigned(F.col(key).bitwiseXOR(F.lit(_LOW)), 64 - bits)


def _first_key(prefix: int, bits: int) -> int | None:
    return None if prefix >> bits else (prefix << (64 - bits)) + _LOW


def _open_rows(keys: DataFrame, key: str, done: int, open_at: set[tuple[int, int]]) -> DataFrame:
    """Rows of the ranges still open: (high, prefix) when ``key`` is the low part."""
    if key == "high":
        return keys if not done else keys.where(_prefix(key, done).isin(sorted({p for _, p in open_at})))
    inside = F.lit(False)
    for high in sorted({h for h, _ in open_at}):
        within = F.col("high") == high
        if done:
            within = within & _prefix(key, done).isin(sorted(p for h, p in open_at if h == high))
        inside = inside | within
    return keys.where(inside)


def find_boundaries(keys: DataFrame, shards: int, tolerance: float) -> tuple[list[Boundary], bool]:
    """Boundaries between shards, and whether one point of the order outweighs the tolerance.

    ``keys`` is ``(high, low, size)``.
    """
    total = keys.agg(F.sum("size")).first()[0] or 0
    slack = tolerance * total / shards
    found: dict[int, Boundary] = {}
    stuck = False
    # Per splitter still open: (high key or 0, prefix so far, bytes below that range).
    waiting = {j: (0, 0, 0) for j in range(1, shards)} if total else {}
    for key in ("high", "low"):
        done = 0
        while waiting and done < 64:
            bits = min(64, done + ROUND_BITS)
            open_at = {(h, p) for h, p, _ in waiting.values()}
            rows = _open_rows(keys, key, done, open_at)
            owner = F.col("high") if key == "low" else F.lit(0).cast("long")
            counted = rows.groupBy(owner.alias("owner"), _prefix(key, bits).alias("prefix")).agg(
                F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")
            )
            parts: dict[tuple[int, int], list] = {}
            for r in counted.collect():
                prefix = r["prefix"] & (1 << 64) - 1
                parent = prefix >> (bits - done) if done else 0
                parts.setdefault((r["owner"], parent), []).append((prefix, r["bytes"], r["rows"]))
            still = {}
            for j, (high, parent, below) in waiting.items():
                goal = total * j / shards
                for prefix, weight, rows_in in sorted(parts[high, parent]):
                    if below + weight >= goal:
                        break
                    below += weight
                near, far = goal - below, below + weight - goal
                edge = prefix + (far < near)
                at = _first_key(edge, bits)
                if min(near, far) <= slack or rows_in == 1:
                    if key == "high":
                        found[j] = Boundary(at)
                    elif at is None:  # past all rows of this high key
                        found[j] = Boundary(high + 1 if high < -_LOW - 1 else None)
                    else:
                        found[j] = Boundary(high, at)
                elif bits < 64:
                    still[j] = (high, prefix, below)
                elif key == "high":
                    still[j] = (prefix + _LOW, 0, below)
                else:
                    found[j] = Boundary(high, at if at is not None else -_LOW - 1)
                    stuck = True
            waiting, done = still, bits
    return [found.get(j, Boundary(None)) for j in range(1, shards)], stuck


def _shard(boundaries: list[Boundary]) -> Column:
    shard = F.lit(0)
    for b in boundaries:
        if b.high is not None:
            past = (F.col("high") > b.high) | ((F.col("high") == b.high) & (F.col("low") >= b.low))
            shard = shard + past.cast("int")
    return shard


def _with_keys(docs: DataFrame, low: Column) -> DataFrame:
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "_stamp"]).alias("document"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("high"),
        low.alias("low"),
        size_of(F.col("text")).alias("size"),
    )


def shard_documents(docs: DataFrame, shards: int, tolerance: float = TOLERANCE) -> DataFrame:
    """``(document, size, shard, slot)``: every row, in shards of near equal bytes.

    ``document`` holds the columns of ``docs``; slots count from 0 without a gap in each shard.
    """
    spark, tables = docs.sparkSession, Tables(docs.sparkSession)
    whole_row = F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema if _hashable(f.dataType)])
    keyed = _with_keys(docs, whole_row)
    keys = tables.cut(keyed.select("high", "low", "size"), "keys")
    boundaries, stuck = find_boundaries(keys, shards, tolerance)
    if stuck:
        stamped = tables.cut(docs.withColumn("_stamp", F.monotonically_increasing_id()), "stamped")
        keyed = _with_keys(stamped, F.xxhash64("_stamp"))
        tables.drop(keys)
        keys = tables.cut(keyed.select("high", "low", "size"), "keys")
        boundaries, _ = find_boundaries(keys, shards, tolerance)
    # Shards are numbered cell by cell, so that a shard is many tasks; cells follow the
    # number of shuffle partitions and hash evenly, whatever the texts.
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = max(1, math.ceil(CELLS_PER_PARTITION * partitions / shards))
    cell = F.pmod(F.col("low"), F.lit(cells)).cast("int")
    place = {"shard": _shard(boundaries), "_cell": cell}
    before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = keys.withColumns(place).groupBy("shard", "_cell").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = counts.select(
        "shard", "_cell", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    offsets = tables.cut(offsets, "offsets")
    tables.drop(keys)
    inside = Window.partitionBy("shard", "_cell").orderBy("high", "low")
    numbered = keyed.withColumns(place).withColumn("_nth", F.row_number().over(inside))
    return numbered.join(offsets, ["shard", "_cell"]).select(
        "document", "size", "shard", (F.col("_offset") + F.col("_nth") - 1).alias("slot")
    )

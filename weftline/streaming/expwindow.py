"""The exponential window over a stream of bits, in order of event time.

Keys are dealt by hash to groups that share one state, so that what a micro-batch costs follows
its rows and the groups, not how many keys they are scattered over. A group's rows wait in
buckets of time, one map entry and one timer per bucket. When the watermark has passed a bucket's
end, its rows are pushed in the order of ``(ts, event_id)``, however they arrived, and the entry
goes; no more than a bucket is ever held at once. Rows later than the watermark are dropped by
Spark; rows without a bit only move the watermark. A key's window is two blocks per level: its
state grows with the logarithm of the width.

A stream can start from the blocks of a batch (``final_blocks``), which become its first state.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, DataType, TimestampType

from weftline.operators.expwindow import final_blocks, number_bits, top_level
from weftline.plans.inputs import purchase_bit
from weftline.shared import cut, new_path
from weftline.sources.tables import table

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = "n bigint, estimate double, levels array<int>, ones array<bigint>"
BUCKET_MS = 60_000
# Groups of keys at least, and the keys of one, where their number is known.
GROUPS = 64
GROUP_KEYS = 1_024
# A table that is replayed: rows of a micro-batch, and of a bucket of the group with most rows.
REPLAY_ROWS = 500_000
BUCKET_ROWS = 1_000
_BUCKET = "us array<bigint>, event_id array<bigint>, bit array<int>, name array<string>"
# Of each key the bits seen, its blocks per level, and the blocks of all keys in turn.
_WINDOWS = "name array<string>, n array<bigint>, counts array<int>, ones array<bigint>"


class Window:
    """Blocks of ones per level, oldest first; level i's blocks are 2^i bits long."""

    def __init__(self, width: int, n: int = 0, blocks: list[list[int]] | None = None):
        self.width, self.n = width, n
        self.blocks = blocks or [[] for _ in range(top_level(width) + 1)]

    def push(self, bit: int) -> None:
        self.n += 1
        *lower, top = self.blocks
        for level in lower:
            level.append(bit)
            if len(level) < 3:
                break
            bit = level[0] + level[1]
            del level[:2]
        else:
            top.append(bit)
        size = 2 ** len(lower)
        inside = (self.n + 1) // size - 1 - max(0, (self.n - self.width) // size)
        del top[: len(top) - max(0, inside)]

    def estimate(self, k: int) -> float:
        """Whole blocks within the last k bits, and half of the one that straddles them."""
        seen, ones = 0, 0.0
        for level, blocks in enumerate(self.blocks):
            for block in reversed(blocks):
                if seen >= k:
                    return ones
                seen += 2**level
                ones += block if seen <= k else block / 2
        return ones


class _PushInOrder(StatefulProcessor):
    """The windows of a group of keys, which go by their names as text."""

    def __init__(self, width: int, k: int, every: int, bucket_ms: int):
        self.width, self.k, self.every, self.bucket_ms = width, k, every, bucket_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "bucket bigint", _BUCKET)
        self.windows = handle.getValueState("windows", _WINDOWS)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """The live blocks ``(name, n, level, block, ones)`` of what went before."""
        # The parts of a large group come one by one.
        windows = self._kept()
        rows = initialState.sort_values(["level", "block"])
        for name, n, level, ones in zip(*(rows[c].tolist() for c in ("name", "n", "level", "ones")), strict=True):
            windows.setdefault(name, Window(self.width, n)).blocks[level].append(ones)
        self._keep(windows)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            known = batch[batch["bit"] >= 0]
            bucket = known["us"] // (self.bucket_ms * 1_000)
            for at, mine in known.groupby(bucket):
                at = (int(at),)
                more = tuple(mine[c].tolist() for c in ("us", "event_id", "bit", "name"))
                if self.waiting.containsKey(at):
                    more = tuple([*a, *b] for a, b in zip(self.waiting.getValue(at), more, strict=True))
                self.waiting.updateValue(at, more)
                self.handle.registerTimer((at[0] + 1) * self.bucket_ms)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() // self.bucket_ms
        due = sorted(name[0] for name in self.waiting.keys() if name[0] < passed)
        if not due:
            yield pd.DataFrame()
            return
        windows = self._kept()
        for bucket in due:
            us, ids, bits, names = self.waiting.getValue((bucket,))
            self.waiting.removeKey((bucket,))
            reports = []
            for i in np.lexsort((ids, us)).tolist():
                window = windows.get(names[i])
                if window is None:
                    window = windows[names[i]] = Window(self.width)
                window.push(int(bits[i]))
                if window.n % self.every == 0:
                    levels = [level for level, blocks in enumerate(window.blocks) for _ in blocks]
                    ones = [b for blocks in window.blocks for b in blocks]
                    reports.append((names[i], window.n, window.estimate(self.k), levels, ones))
            yield pd.DataFrame(reports, columns=["name", "n", "estimate", "levels", "ones"])
        self._keep(windows)

    def _kept(self) -> dict:
        windows: dict = {}
        if self.windows.exists():
            names, seen, counts, ones = self.windows.get()
            left, blocks = iter(counts), iter(ones)
            for name, n in zip(names, seen, strict=True):
                levels = [list(islice(blocks, c)) for c in islice(left, top_level(self.width) + 1)]
                windows[name] = Window(self.width, n, levels)
        return windows

    def _keep(self, windows: dict) -> None:
        levels = [level for w in windows.values() for level in w.blocks]
        seen, counts = [w.n for w in windows.values()], [len(level) for level in levels]
        self.windows.update((list(windows), seen, counts, [int(b) for level in levels for b in level]))

    def close(self) -> None:
        pass


def _as_text(key: Column, kind: DataType) -> Column:
    """A key by name: pandas has no column of integers that holds a NULL."""
    if isinstance(kind, BinaryType):
        return F.hex(key)
    return (F.unix_micros(key) if isinstance(kind, TimestampType) else key).cast("string")


def _from_text(name: Column, kind: DataType) -> Column:
    if isinstance(kind, BinaryType):
        return F.unhex(name)
    return F.timestamp_micros(name.cast("long")) if isinstance(kind, TimestampType) else name.cast(kind)


def _group(groups: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(groups)).alias("grp")


def stream_estimates(
    events: DataFrame,
    width: int,
    k: int,
    every: int = 10,
    delay: str = "0 seconds",
    bucket_ms: int = BUCKET_MS,
    before: DataFrame | None = None,
    groups: int = GROUPS,
) -> DataFrame:
    """``(key, n, estimate, levels, ones)`` every so many bits of each key of a stream.

    ``events`` is a streaming ``(key, ts, event_id, bit)``. ``levels`` and ``ones`` list the live
    blocks, oldest first within a level. ``before`` holds the live blocks ``(key, n, level, block,
    ones)`` of bits that went before. The windows of a group's keys are read and written together,
    so ``groups``, which stays the same for the life of a stream, should leave some thousands of
    keys in one. Needs the RocksDB state store.
    """
    if not 1 <= k <= width:
        raise ValueError("k must lie between 1 and the window width")
    kind = events.schema["key"].dataType
    name = _as_text(F.col("key"), kind).alias("name")
    us, bit, event_id = F.unix_micros("ts"), F.col("bit").cast("int"), F.col("event_id").cast("long")
    timed = events.withWatermark("ts", delay).select(
        "ts",
        _group(groups),
        name,
        F.coalesce(us, F.lit(0)).alias("us"),
        F.coalesce(event_id, F.lit(-(1 << 63))).alias("event_id"),
        # Less than 0: only moves the watermark.
        F.when(us.isNotNull() & bit.isNotNull(), bit).otherwise(-1).alias("bit"),
    )
    if before is not None:
        before = before.withColumn("key", F.col("key").cast(kind)).select(_group(groups), name, "n", "level", "block", "ones")
    found = timed.groupBy("grp").transformWithStateInPandas(
        statefulProcessor=_PushInOrder(width, k, every, bucket_ms),
        outputStructType=f"name string, {OUTPUT}",
        outputMode="Append",
        timeMode="EventTime",
        initialState=None if before is None else before.groupBy("grp"),
    )
    return found.select(_from_text(F.col("name"), kind).alias("key"), "n", "estimate", "levels", "ones")


def _staged(events: DataFrame, rows: int) -> str:
    """Write ``(key, ts, event_id, bit)`` as files in the order of time, which a stream reads so."""
    spark, path = events.sparkSession, new_path(events.sparkSession, "stream-input")
    files = max(1, math.ceil(events.count() / rows))
    events.repartitionByRange(files, "ts", "event_id").write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(str(f.getPath()) for f in system.listStatus(folder) if f.getPath().getName().startswith("part-"))
    # A file stream takes files by their time of change; tasks may have ended in any order.
    latest = max((f.getModificationTime() for f in system.listStatus(folder)), default=0)
    for i, name in enumerate(names):
        system.setTimes(spark._jvm.org.apache.hadoop.fs.Path(name), latest - 1_000 * (len(names) - i), -1)
    return path


def replay(
    events: DataFrame,
    width: int,
    k: int,
    every: int = 10,
    rows: int = REPLAY_ROWS,
    before: DataFrame | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Run a table ``(key, ts, event_id, bit)`` through ``stream_estimates``, to its last event.

    Micro-batches of about so many rows follow the order of time. A row without a bit, behind all
    others, then moves the watermark past the last of them. Buckets are as long as hold about
    ``bucket_rows`` rows of the group of keys that has most.
    """
    spark = events.sparkSession
    events = cut(events, "events")
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    session.conf.set("spark.sql.session.timeZone", "UTC")
    staged, closing = _staged(events, rows), new_path(spark, "stream-end")
    span = events.agg(F.min(F.unix_millis("ts")), F.max(F.unix_millis("ts"))).first()
    groups = max(GROUPS, math.ceil(events.select("key").distinct().count() / GROUP_KEYS))
    most = events.groupBy(_group(groups)).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    bucket_ms = max(1, ((span[1] or 0) - (span[0] or 0)) * bucket_rows // most + 1)
    gap = max(bucket_ms, 86_400_000)
    last = events.agg((F.unix_millis(F.max("ts")) + F.lit(gap)).alias("ms")).selectExpr("timestamp_millis(ms) AS ts")
    none = {c: F.lit(None).cast(events.schema[c].dataType) for c in ("key", "event_id", "bit")}
    end = last.withColumns(none).select(events.columns)
    end.where(F.lit(False)).write.parquet(closing)
    out, progress = new_path(spark, "stream"), new_path(spark, "stream-progress")
    schema = events.schema
    started = None if before is None else session.read.schema(before.schema).parquet(_written(before))
    for _ in range(2):
        source = session.readStream.schema(schema).option("maxFilesPerTrigger", 1)
        both = source.parquet(staged).unionByName(source.parquet(closing))
        query = (
            stream_estimates(both, width, k, every, bucket_ms=bucket_ms, before=started, groups=groups)
            .writeStream.outputMode("append")
            .trigger(availableNow=True)
            .option("checkpointLocation", progress)
            .format("parquet")
            .start(out)
        )
        query.awaitTermination()
        end.write.mode("append").parquet(closing)
    key_type = events.schema["key"].dataType.simpleString()
    return spark.read.schema(f"key {key_type}, {OUTPUT}").parquet(out)


def _written(df: DataFrame) -> str:
    """The folder of a copy, for a reader in another session."""
    path = new_path(df.sparkSession, "blocks")
    df.write.parquet(path)
    return path


def _table_bits(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("user_id").alias("key"),
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
        purchase_bit().cast("int").alias("bit"),
    )


def replay_events(spark: SparkSession, folder: str, width: int, k: int, every: int = 10) -> DataFrame:
    """The event table as a stream; its output as written by the stream."""
    return replay(_table_bits(spark, folder), width, k, every)


def resume_events(spark: SparkSession, folder: str, width: int, k: int, every: int = 10) -> DataFrame:
    """The later half of the events as a stream that starts from the blocks of the earlier half."""
    events = _table_bits(spark, folder)
    middle = events.agg(F.expr("timestamp_micros((unix_micros(min(ts)) + unix_micros(max(ts))) div 2) AS t")).first()[0]
    at = F.lit(middle)
    bits = number_bits(events.where(F.col("ts") <= at), "key", ["ts", "event_id"], F.col("bit"))
    before = final_blocks(bits, width).select("key", "n", "level", "block", "ones")
    return replay(events.where(F.col("ts") > at), width, k, every, before=before)

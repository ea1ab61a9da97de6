import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.operators import expwindow, polyfit
from weftline.streaming import expwindow as streamed

CURVE = [(float(x), 0.2 * x * x + 0.2 * x + 0.2) for x in range(10)]


@pytest.fixture(scope="module")
def curve(spark):
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(CURVE)], "at int, x double, y double")


def test_moments_and_error(curve):
    m = polyfit.moments(curve, 2).first()
    assert [m[f"x{i}"] for i in range(5)] == [10, 45, 285, 2025, 15333]
    assert [m[f"xy{i}"] for i in range(3)] == pytest.approx([68, 471, 3528.6])
    assert polyfit.squared_error(curve, [0, 0, 0]).first()[0] == pytest.approx(813.52)
    assert polyfit.squared_error(curve, [0.2, 0.2, 0.2]).first()[0] == pytest.approx(0, abs=1e-12)


def stepwise(points, degree, rate, epochs, target, w=None):
    w = np.zeros(degree + 1) if w is None else np.array(w, dtype=float)
    sse, done = np.inf, 0
    while done < epochs and not sse <= target:
        before = w.copy()
        for x, y in points:
            f = x ** np.arange(degree + 1)
            w = w - 2 * rate * (w @ f - y) * f
        sse = sum((y - w @ (x ** np.arange(degree + 1))) ** 2 for x, y in points)
        done += 1
        if np.array_equal(w, before):
            break
    return w, done, sse


def test_descent_takes_the_same_steps_as_a_loop(curve):
    w, epochs, sse = stepwise(CURVE, 2, 0.0001, 4000, 0.01, [0.5, 0.5, 0.5])
    found = polyfit.fit(curve, 2, 0.0001, ["at"], start=[0.5, 0.5, 0.5]).first()
    assert found.epochs == epochs and 1 < epochs < 4000
    assert found.coefficients == pytest.approx(list(w), rel=1e-6)
    assert found.sse == pytest.approx(sse, rel=1e-4)
    tight = polyfit.fit(curve.withColumn("x", F.col("x") / 9), 2, 0.1, ["at"], max_epochs=100_000, target_error=1e-9)
    assert tight.first().coefficients == pytest.approx([0.2, 1.8, 16.2], abs=1e-3)


def test_descent_per_key_over_many_tasks(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.enabled", "false")
    session.conf.set("spark.sql.shuffle.partitions", "9")
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    rng = np.random.default_rng(2)
    drawn = [(k, i, x) for k in ("1", "2") for i, x in enumerate(rng.random(70).tolist())]
    rows = [(k, i, x, x * int(k) + rng.normal(scale=0.1)) for k, i, x in drawn]
    df = session.createDataFrame(rows, "key string, at int, x double, y double").repartition(5)
    found = {r.key: r for r in polyfit.fit_by_key(df, 1, 0.01, ["at"], 50, 0.0).collect()}
    for k in ("1", "2"):
        w, epochs, _ = stepwise([(x, y) for kk, _, x, y in rows if kk == k], 1, 0.01, 50, 0.0)
        assert found[k].epochs == epochs and found[k].coefficients == pytest.approx(list(w))


def test_a_diverging_rate_ends(curve):
    assert polyfit.fit(curve, 2, 1.0, ["at"]).first().epochs < 4000


PATTERN = [int(b) for b in "1011011100101101" * 4]


def bits_of(spark, streams):
    rows = [(k, p, b) for k, bits in streams.items() for p, b in enumerate(bits)]
    return spark.createDataFrame(rows, "key bigint, pos bigint, bit int")


@pytest.mark.parametrize(
    ("n", "k", "blocks", "estimate", "actual"),
    [
        (5, 3, [(0, 2), (2, 4), (4, 5)], 2, 2),
        (8, 5, [(0, 4), (4, 6), (6, 7), (7, 8)], 4.5, 4),
        (16, 7, [(0, 8), (8, 12), (12, 14), (14, 15), (15, 16)], 3.5, 4),
        (16, 15, [(0, 8), (8, 12), (12, 14), (14, 15), (15, 16)], 7, 9),
        (31, 18, [(8, 16), (16, 24), (24, 28), (28, 30), (30, 31)], 11, 11),
        (40, 15, [(16, 24), (24, 32), (32, 36), (36, 38), (38, 39), (39, 40)], 8, 10),
    ],
)
def test_known_windows(spark, n, k, blocks, estimate, actual):
    bits = bits_of(spark, {1: PATTERN[:n]})
    found = expwindow.final_blocks(bits, 20).orderBy("first_pos").collect()
    assert [(r.first_pos, r.last_pos + 1) for r in found] == blocks
    assert [r.ones for r in found] == [sum(PATTERN[a:b]) for a, b in blocks]
    report = expwindow.error_report(bits, 20, k, every=n).first()
    assert (report.estimate, report.actual) == (estimate, actual)


def test_windows_agree_with_pushing_bit_by_bit(spark):
    rng = np.random.default_rng(6)
    streams = {w: rng.integers(0, 2, 90).tolist() for w in range(3)}
    bits = bits_of(spark, streams)
    for width in (1, 5, 20, 33):
        got = {(r.key, r.n): r.estimate for r in expwindow.estimates(bits, width, width, 1).collect()}
        for key, stream in streams.items():
            window = streamed.Window(width)
            for n, bit in enumerate(stream, 1):
                window.push(bit)
                assert got[key, n] == window.estimate(width)


def test_exact_counts_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(expwindow, "CHUNK", 16)
    got = {r.n: r.ones for r in expwindow.ones_exact(bits_of(spark, {1: PATTERN}), 7).collect()}
    assert got == {n: sum(PATTERN[max(0, n - 7) : n]) for n in range(1, 65)}


def test_errors_of_all_zero_bits_and_too_long_spans(spark):
    bits = bits_of(spark, {1: [0] * 20})
    assert all(r.relative_error is None for r in expwindow.error_report(bits, 20, 20).collect())
    with pytest.raises(ValueError):
        expwindow.estimates(bits, 20, 21)
    with pytest.raises(ValueError):
        streamed.stream_estimates(bits, 20, 21)


def test_stream_with_disorder_and_late_events(spark, tmp_path):
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", streamed.STORE)
    session.conf.set("spark.sql.shuffle.partitions", "2")
    schema = "key bigint, second bigint, event_id bigint, bit int"

    def drop(name, rows):
        session.createDataFrame(rows, schema).coalesce(1).write.json(str(tmp_path / "in" / name))
        time.sleep(1.1)  # files are taken in order of modification time

    rows = [(1, 100 + s, s, PATTERN[s]) for s in range(60)]
    shuffled = [rows[i] for i in np.random.default_rng(0).permutation(40)]
    drop("a", shuffled)
    drop("b", rows[40:] + [(2, 10_000, 0, 1)])  # the far row moves the watermark past the rest
    drop("c", [(1, 105, 999, 1)])  # later than the watermark: dropped
    events = (
        session.readStream.schema(schema)
        .option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true")
        .json(str(tmp_path / "in"))
        .select(
            F.concat(F.lit("user "), "key").alias("key"),
            F.timestamp_seconds("second").alias("ts"),
            "event_id",
            "bit",
        )
    )
    query = (
        streamed.stream_estimates(events, 20, 15, every=5, delay="5 seconds")
        .writeStream.outputMode("append")
        .trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "progress"))
        .format("parquet")
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("n").collect()
    bits = bits_of(spark, {1: PATTERN[:60]})
    expected = {r.n: r.estimate for r in expwindow.estimates(bits, 20, 15, 5).collect()}
    assert {r.n: r.estimate for r in got} == expected and {r.key for r in got} == {"user 1"}
    live = expwindow.live_blocks(bits.selectExpr("key", "pos + 1 AS n").where("n = 60"), 20)
    ones = live.join(expwindow.block_sums(bits, 20), ["key", "level", "block"]).orderBy("level", "block")
    assert [(r.level, r.ones) for r in ones.collect()] == list(zip(got[-1].levels, got[-1].ones, strict=True))


def some_events(spark, users, each, seed=2):
    """One user with a third of all events and many at the same moment."""
    rng = np.random.default_rng(seed)
    who = np.concatenate([np.repeat(np.arange(users), each), np.full(users * each // 2, 99)])
    rows = [
        (int(u), int(t), i, int(b))
        for i, (u, t, b) in enumerate(zip(who, rng.integers(0, 4_000, len(who)), rng.integers(0, 2, len(who)), strict=True))
    ]
    df = spark.createDataFrame(rows, "key bigint, ms bigint, event_id bigint, bit int")
    return df.select("key", F.timestamp_millis("ms").alias("ts"), "event_id", "bit")


def batch_estimates(events, width, k):
    bits = expwindow.number_bits(events, "key", ["ts", "event_id"], F.col("bit"))
    return {(r.key, r.n): r.estimate for r in expwindow.estimates(bits, width, k).collect()}


def test_replay_holds_one_bucket_of_a_busy_user(spark, monkeypatch):
    """All events come out, in bounded batches, and no bucket holds more than a part of the user."""
    longest = 60

    class Bounded(streamed._PushInOrder):
        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            for name in list(self.waiting.keys()):
                held = len(self.waiting.getValue(name)[0])
                if held > longest:
                    raise ValueError(f"{held} rows in one bucket")
            yield from super().handleExpiredTimer(key, timerValues, expiredTimerInfo)

    monkeypatch.setattr(streamed, "_PushInOrder", Bounded)
    events = some_events(spark, 6, 50)
    got = streamed.replay(events, 20, 15, rows=120, bucket_rows=20).collect()
    assert {(r.key, r.n): r.estimate for r in got} == batch_estimates(events, 20, 15)
    assert len(got) == 6 * 5 + 15


def test_replay_calls_follow_groups_not_keys(spark, monkeypatch, tmp_path):
    """Many keys with few events each: a micro-batch visits a group of them at once."""
    calls = tmp_path / "calls"

    class Counted(streamed._PushInOrder):
        def handleInputRows(self, key, rows, timerValues):
            with open(calls, "a") as f:
                f.write(".")
            yield from super().handleInputRows(key, rows, timerValues)

    monkeypatch.setattr(streamed, "_PushInOrder", Counted)
    # Spark takes events of the first moment of 1970 for late ones.
    events = some_events(spark, 300, 20).withColumn("ts", F.expr("ts + INTERVAL 1 DAY"))
    got = streamed.replay(events, 20, 15, rows=10_000).collect()
    assert {(r.key, r.n): r.estimate for r in got} == batch_estimates(events, 20, 15)
    assert calls.stat().st_size <= 2 * 64 + 2


def test_stream_keeps_null_and_large_keys_apart(spark):
    """Keys beyond 2^53 beside a NULL one, with events whose ids are as large."""
    keys = (None, 2**53, 2**53 + 1)
    rows = [(k, i, 2**60 - i, i * (j + 1) % 3 % 2) for j, k in enumerate(keys) for i in range(30)]
    df = spark.createDataFrame(rows, "key bigint, ms bigint, event_id bigint, bit int")
    events = df.select("key", F.timestamp_millis(F.expr("1000 + ms div 4")).alias("ts"), "event_id", "bit")
    got = {(r.key, r.n): r.estimate for r in streamed.replay(events, 20, 15).collect()}
    assert {at for at in got if at[0] is None} == {(None, 10), (None, 20), (None, 30)}
    assert {at: e for at, e in got.items() if at[0] is not None} == batch_estimates(events, 20, 15)


def test_stream_goes_on_from_blocks(spark):
    events = some_events(spark, 4, 40)
    early, late = events.where("ts <= timestamp_millis(1500)"), events.where("ts > timestamp_millis(1500)")
    bits = expwindow.number_bits(early, "key", ["ts", "event_id"], F.col("bit"))
    before = expwindow.final_blocks(bits, 20).select("key", "n", "level", "block", "ones")
    got = {(r.key, r.n): r.estimate for r in streamed.replay(late, 20, 15, before=before).collect()}
    counts = {r.key: r["count"] for r in early.groupBy("key").count().collect()}
    expected = {at: e for at, e in batch_estimates(events, 20, 15).items() if at[1] > counts.get(at[0], 0)}
    assert got == expected and got


def test_replay_of_no_events(spark):
    assert streamed.replay(some_events(spark, 1, 2).limit(0), 20, 15).collect() == []


def test_null_keys_are_fitted_too(spark):
    for kind, keys in (("string", ("a", None)), ("bigint", (1, None))):
        rows = [(k, i, float(i), 2.0 * i) for k in keys for i in range(5)]
        df = spark.createDataFrame(rows, f"key {kind}, at int, x double, y double")
        found = {r.key: r.coefficients for r in polyfit.fit_by_key(df, 1, 0.01, ["at"], 30, 0.0).collect()}
        assert set(found) == set(keys) and found[None] == pytest.approx(found[keys[0]])


def test_stream_reads_a_table_stored_as_a_folder(spark, tmp_path):
    events = [(i, f"2024-01-01 00:00:{i % 60:02d}", i % 2, t) for i, t in enumerate(["purchase", "view", None] * 20)]
    df = spark.createDataFrame(events, "event_id bigint, ts string, user_id bigint, event_type string")
    df = df.withColumn("ts", F.to_timestamp_ntz("ts"))
    df.repartition(3).write.parquet(f"{tmp_path}/folder/events.parquet")
    rows = streamed.replay_events(spark, f"{tmp_path}/folder", 20, 15).collect()
    assert {r.n for r in rows} >= {10, 20} and all(0 <= r.estimate <= 15 for r in rows)

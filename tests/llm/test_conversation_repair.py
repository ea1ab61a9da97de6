"""Conversation repair against a shortest path over rows and states."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from weftline.llm import conversation_repair as c

BLANK = re.compile(r"[^\x20\x09-\x0D]")
SCHEMA = "conv_id bigint, turn bigint, role string, text string"
STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def parse(rows):
    """The least (cost, audit, lines) by Dijkstra over (rows done, last role)."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, lines = heapq.heappop(heap)
        if (i, last) in seen:
            continue
        if i == len(rows) and last in ("", "a"):
            return cost, audit, lines
        seen.add((i, last))
        for r, name in (("u", "user"), ("a", "assistant")):
            if (last, r) in STEP:
                heapq.heappush(heap, (cost + 5, audit + "I", i, r, (*lines, f"{name}:")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, last, lines))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                options = [(more, "K", role[:1], role)]
                options += [(more + 1, "R", n[0], n) for n in ("user", "assistant")]
                for extra, edit, r, name in options:
                    if (last, r) in STEP:
                        line = f"{name}:{text}"
                        heapq.heappush(heap, (cost + extra, audit + edit, i + 1, r, (*lines, line)))


def brute(turns):
    """Of (turn, role, text) rows of one conversation, nulls filled in."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in turns]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    judged, earlier = [], set()
    for _, role, text in rows:
        held = BLANK.findall(text)
        fault = "blank" if not held else "duplicate" if (role, text) in earlier else "" if held[-1] in ".!?" else "truncated"
        earlier.add((role, text))
        judged.append((role, text, fault))
    known = [t for t, *_ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    counts = [sum(f == k for *_, f in judged) for k in ("blank", "duplicate", "truncated")]
    illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
    cost, audit, lines = parse(judged)
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def check(spark, rows, parts=3):
    by_conv = {}
    for conv, *turn in rows:
        by_conv.setdefault(conv, []).append(turn)
    found = c.repair(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()
    assert {r["conv_id"]: tuple(r[n] for n in NAMES) for r in found} == {k: brute(v) for k, v in by_conv.items()}
    assert len(found) == len(by_conv)


def some_rows(seed, conversations, longest):
    rng = random.Random(seed)
    texts = ["", " \t", "Hi.", "Hi", "Why?", "so\n", "End! ", "été.", "a.b"]
    rows = []
    for conv in range(conversations):
        for t in range(rng.randint(1, longest)):
            turn = rng.choice([t, t, t, t + 1, None])
            role = rng.choice(["user", "assistant"] * 3 + ["system", "tool", None, "User", ""])
            rows.append((conv, turn, role, rng.choice(texts + [f"Text {t}.", f"Text {t}"] * 4)))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_against_shortest_paths(spark, seed):
    check(spark, some_rows(seed, 60, 9))


def test_long_conversations_over_many_parts(spark):
    check(spark, some_rows(7, 2, 300) + some_rows(8, 3, 5), parts=8)


def test_chart_has_the_same_cell_at_every_cut():
    rng = random.Random(3)
    rows = tuple((rng.choice("sua-"), rng.randrange(4)) for _ in range(9))
    whole = c.chart(rows)
    for k in range(1, 9):
        assert c.join(c.chart(rows[:k]), c.chart(rows[k:])) == whole


def test_edge_cases(spark):
    rows = [
        (None, None, None, None),
        (1, None, "user", "No turn."),
        (2, 5, "assistant", "x" * 300_000 + "."),
        (2, 5, "assistant", "x" * 300_000 + "."),
        (3, 1, "system", "Only this."),
        (4, 0, "user", ""),
    ]
    check(spark, rows)
    extra = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA + ", key string, at bigint")
    assert c.repair(extra).count() == 5
    empty = spark.createDataFrame([], SCHEMA)
    assert c.repair(empty).collect() == []
    ids = spark.createDataFrame([(9,)], "conv_id bigint")
    (row,) = c.repair(empty, ids).collect()
    assert tuple(row) == (9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Yes."), (1, 2, "user", "Cut"), (1, 3, "user", "Why?")]
    r = c.Repair(spark.createDataFrame(rows, SCHEMA))
    lines = [(x["role"], x["text"]) for x in r.repaired().orderBy("at", "line").collect()]
    (_, audit, expected) = parse([(a, b, "truncated" if b == "Cut" else "") for _, _, a, b in rows])
    assert [f"{a}:{b}" for a, b in lines] == list(expected)
    assert r.summary().first()["audit"] == audit


def test_damage(spark):
    rows = [(c_, t, "assistant", "Well. Now?") for c_ in range(8) for t in range(20)] + [(None, None, None, None)]
    got = sorted(map(tuple, c.damaged(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    expected = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = role or " ", text or " "
        if kind:
            changed = {1: (role, ""), 2: (role, "Well Now" if conv is not None else " "), 4: ("user", text)}
            expected += [(conv, turn, *changed.get(kind, (role, text)))] * (2 if kind == 3 else 1)
    assert got == sorted(expected, key=repr)

"""Repair of conversations by weighted CYK interval parsing.

A conversation should read as an optional system turn and then user and assistant in turn. What a
span of rows can become is written as a grammar in Chomsky normal form: ``P>Q`` is whatever leads
from state P to state Q, and ``P>Q -> P>R R>Q`` are its rules. A row alone may be kept, given
another role or deleted; turns may be inserted anywhere, so every cell is closed under
insertions. A cell of the chart holds, for each ``P>Q``, the least ``(cost, audit)``, audit being
the edits' initials in order: Delete, Insert, Keep, Rerole. Of two audits of equal cost over the
same rows neither begins the other (only insertions could follow, and they cost), so least pairs
of parts make the least pair of the whole.

Charts are filled bottom-up by span length. Since ``P>R R>Q`` covers every cut of a span alike, a
long conversation needs no chart of all its spans: runs of ``BLOCK`` rows get a whole chart, and
spans of equal length are then joined two by two. Rows are range-partitioned on their full order,
so a conversation of any length is parsed in many tasks, of which each hands on one row; its
edits go back to the rows by their place in the order. Only the SHA-256 of a conversation, which
is one message, is read in one task, row after row.

Faults, the first of which counts: blank (nothing but white space), duplicate (role and text of
an earlier row), truncated (does not end in ``.``, ``!`` or ``?``). Blank and duplicate rows must
be deleted; a truncated one that stays adds its cost.

Defined results: null roles and texts are one space; null turns come first; rows of one turn are
in the order of role and text; roles count by their first letter, and one other than s, u or a is
never legal; a null conv_id is a conversation of its own; repeated rows are duplicates; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from operator import add

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.shared import Tables

BLOCK = 16
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
NO_FAULT, IS_BLANK, IS_DUPLICATE, IS_TRUNCATED = range(4)

# States: nothing yet, after the system turn, after a user turn, after an assistant turn.
STATES = range(4)
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPTED = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
BLANKS = " \t\n\x0b\x0c\r"

# monotonically_increasing_id() keeps the partition number above bit 33.
_PART_BITS = 33

# A cell: per pair of states, at 4 * P + Q, the least (cost, audit), or None.
Cell = list


def _reached() -> set[tuple[int, int]]:
    found = {(p, p) for p in STATES}
    while True:
        more = found | {(p, NEXT[q, c]) for p, q in found for c in "sua" if (q, c) in NEXT}
        if more == found:
            return found
        found = more


_PAIRS = _reached()
# The binary rules P>Q -> P>R R>Q, as places in cells.
RULES = [
    (4 * p + q, 4 * p + r, 4 * r + q) for p, q in sorted(_PAIRS) for r in STATES if {(p, r), (r, q)} <= _PAIRS
]


def join(left: Cell, right: Cell, into: Cell | None = None) -> Cell:
    """Apply all binary rules to the cells of two adjoining spans."""
    out: Cell = [None] * 16 if into is None else into
    for whole, first, second in RULES:
        x, y = left[first], right[second]
        if x is None or y is None:
            continue
        best = out[whole]
        if best is None or x[0] + y[0] <= best[0]:
            made = tuple(map(add, x, y))
            if best is None or made < best:
                out[whole] = made
    return out


def _insertions() -> Cell:
    """The closure of inserting turns: what leads from state to state without a row."""
    cell: Cell = [None] * 16
    for p in STATES:
        cell[4 * p + p] = (0, "")
        for c in ROLES:
            if (p, c) in NEXT:
                cell[4 * p + NEXT[p, c]] = (INSERT, "I")
    while True:
        more = join(cell, cell, list(cell))
        if more == cell:
            return cell
        cell = more


INSERTIONS = _insertions()


def row_cell(initial: str, fault: int) -> Cell:
    """What a row alone can become, by its role's initial and its fault."""
    cell: Cell = [None] * 16
    more = TRUNCATED if fault == IS_TRUNCATED else 0
    for p in STATES:
        options = {p: (DELETE, "D")}
        if fault not in (IS_BLANK, IS_DUPLICATE):
            if (p, initial) in NEXT:
                options[NEXT[p, initial]] = (KEEP + more, "K")
            for c in ROLES:
                if (p, c) in NEXT and c != initial:
                    q = NEXT[p, c]
                    options[q] = min(options.get(q, (REROLE + more, "R")), (REROLE + more, "R"))
        for q, edit in options.items():
            cell[4 * p + q] = edit
    return join(join(INSERTIONS, cell), INSERTIONS)


@lru_cache(maxsize=1 << 14)
def chart(rows: tuple[tuple[str, int], ...]) -> Cell:
    """The cell of a whole span, from its rows: all spans, by length, at all cuts.

    Rows of a block are told apart by initial and fault alone, so equal blocks have one chart.
    """
    n = len(rows)
    spans = {(i, i + 1): row_cell(*row) for i, row in enumerate(rows)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cell: Cell = [None] * 16
            for k in range(i + 1, i + length):
                join(spans[i, k], spans[k, i + length], cell)
            spans[i, i + length] = cell
    return spans[0, n]


class Spans:
    """Cells of adjoining spans, joined two by two while the earlier is not the longer."""

    def __init__(self) -> None:
        self.stack: list[tuple[int, Cell]] = []

    def push(self, length: int, cell: Cell) -> None:
        while self.stack and self.stack[-1][0] <= length:
            before, first = self.stack.pop()
            length, cell = before + length, join(first, cell)
        self.stack.append((length, cell))

    def whole(self) -> Cell:
        length, cell = self.stack.pop()
        while self.stack:
            before, first = self.stack.pop()
            cell = join(first, cell)
        return cell


_CELLS = "array<struct<pair: int, cost: bigint, audit: string>>"
_COUNTS = "blank bigint, duplicate bigint, truncated bigint, illegal bigint"
_RUN = (
    f"key string, part bigint, first bigint, initials string, {_COUNTS}, first_turn bigint,"
    f" last_turn bigint, turns bigint, cells {_CELLS}"
)
_LEGAL = {"su", "ua", "au"}


def _cells_out(cell: Iterable) -> list[dict]:
    return [{"pair": i, "cost": c[0], "audit": c[1]} for i, c in enumerate(cell) if c is not None]


def _arrow(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _arrow_schema(ddl: str) -> pa.Schema:
    """Arrow types of the few kinds of columns used here."""
    cells = pa.list_(pa.struct([("pair", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    kinds = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}
    fields = []
    for column in ddl.replace(_CELLS, "cells").split(","):
        name, kind = column.split()
        fields.append((name, cells if kind == "cells" else kinds[kind]))
    return pa.schema(fields)


class _Run:
    """The rows of one conversation in one part, as they come."""

    def __init__(self, key: str, part: int, first: int) -> None:
        self.key, self.part, self.first = key, part, first
        self.initials: list[str] = []
        self.faults = [0, 0, 0, 0]
        self.illegal = 0
        self.first_turn = self.last_turn = None
        self.turns = 0
        self.block: list[tuple[str, int]] = []
        self.spans = Spans()

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        if self.initials and self.initials[-1] + initial not in _LEGAL:
            self.illegal += 1
        self.initials.append(initial)
        self.faults[fault] += 1
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
            self.turns += 1
        self.block.append((initial, fault))
        if len(self.block) == BLOCK:
            self.spans.push(BLOCK, chart(tuple(self.block)))
            self.block = []

    def row(self) -> dict:
        if self.block:
            self.spans.push(len(self.block), chart(tuple(self.block)))
        return {
            "key": self.key,
            "part": self.part,
            "first": self.first,
            "initials": "".join(self.initials),
            "blank": self.faults[IS_BLANK],
            "duplicate": self.faults[IS_DUPLICATE],
            "truncated": self.faults[IS_TRUNCATED],
            "illegal": self.illegal,
            "first_turn": self.first_turn,
            "last_turn": self.last_turn,
            "turns": self.turns,
            "cells": _cells_out(self.spans.whole()),
        }


_ROWS_OUT = 2_000


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation and part; rows come in their order."""
    schema = _arrow_schema(_RUN)
    run: _Run | None = None
    done: list[dict] = []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("key", "at", "turn", "initial", "fault")]
        for key, at, turn, initial, fault in zip(*columns, strict=True):
            part = at >> _PART_BITS
            if run is None or run.key != key or run.part != part:
                if run is not None:
                    done.append(run.row())
                run = _Run(key, part, at)
            run.add(turn, initial, fault)
        if len(done) >= _ROWS_OUT:
            yield _arrow(done, schema)
            done = []
    if run is not None:
        done.append(run.row())
    yield _arrow(done, schema)


_PARSED = (
    "key string, first bigint, initials string, state bigint, edits string, whole boolean,"
    f" gaps bigint, {_COUNTS}, cost bigint, audit string"
)


def _conversation(runs: list[dict]) -> Iterator[dict]:
    """Join the runs of one conversation; every run gets its edits, the last one the sums."""
    spans = Spans()
    for run in runs:
        cell: Cell = [None] * 16
        for c in run["cells"]:
            cell[c["pair"]] = (c["cost"], c["audit"], ((c["pair"] % 4, len(c["audit"])),))
        spans.push(len(run["initials"]), cell)
    whole = spans.whole()
    cost, audit, path = min(whole[q] for q in ACCEPTED if whole[q] is not None)
    sums = {c: sum(r[c] for r in runs) for c in ("blank", "duplicate", "truncated", "illegal")}
    turned = [r for r in runs if r["first_turn"] is not None]
    distinct = sum(r["turns"] for r in turned)
    for before, after in zip(runs, runs[1:]):
        sums["illegal"] += before["initials"][-1] + after["initials"][0] not in _LEGAL
    for before, after in zip(turned, turned[1:]):
        distinct -= before["last_turn"] == after["first_turn"]
    gaps = turned[-1]["last_turn"] - turned[0]["first_turn"] + 1 - distinct if turned else 0
    state = at = 0
    for i, (run, (after, length)) in enumerate(zip(runs, path, strict=True)):
        row = {c: run[c] for c in ("key", "first", "initials")}
        row |= {"state": state, "edits": audit[at : at + length], "whole": False}
        if i == len(runs) - 1:
            row |= sums | {"whole": True, "gaps": gaps, "cost": cost, "audit": audit}
        yield row
        state, at = after, at + length


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _arrow_schema(_PARSED)
    runs: list[dict] = []
    for batch in batches:
        done: list[dict] = []
        for run in batch.to_pylist():
            if runs and runs[0]["key"] != run["key"]:
                done.extend(_conversation(runs))
                runs = []
            runs.append(run)
        yield _arrow(done, schema)
    if runs:
        yield _arrow(list(_conversation(runs)), schema)


_EDITS = "key string, at bigint, before array<string>, edit string, new_role string, behind array<string>"


def _row_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's edit and the turns inserted around it."""
    schema = _arrow_schema(_EDITS)
    done: list[dict] = []
    for batch in batches:
        for run in batch.to_pylist():
            state, place, inserted = run["state"], 0, []
            for edit in run["edits"]:
                initial = run["initials"][place] if edit != "I" else ""
                if edit != "D":
                    # Inserted and given roles are the one of user and assistant that may follow.
                    role = initial if edit == "K" else next(c for c in ROLES if (state, c) in NEXT)
                    state = NEXT[state, role]
                if edit == "I":
                    inserted.append(ROLES[role])
                    continue
                row = {"key": run["key"], "at": run["first"] + place, "before": inserted, "edit": edit, "behind": []}
                done.append(row | {"new_role": ROLES[role] if edit == "R" else None})
                place, inserted = place + 1, []
            done[-1]["behind"] = inserted
            if len(done) >= _ROWS_OUT:
                yield _arrow(done, schema)
                done = []
    yield _arrow(done, schema)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's repaired lines; a row's edit comes before the row."""
    schema = _arrow_schema("key string, repaired_sha256 string")
    names = ("key", "role", "text", "before", "edit", "new_role", "behind")
    key, digest, lines, edit = None, None, 0, None
    for batch in batches:
        done: list[dict] = []
        columns = [batch.column(c).to_pylist() for c in names]
        for now, role, text, before, kind, new_role, behind in zip(*columns, strict=True):
            if now != key:
                if key is not None:
                    done.append({"key": key, "repaired_sha256": digest.hexdigest()})
                key, digest, lines = now, hashlib.sha256(), 0
            if kind is not None:
                edit = (before, kind, new_role, behind)
                continue
            before, kind, new_role, behind = edit
            own = [] if kind == "D" else [f"{new_role or role}:{text}"]
            for line in [*(f"{r}:" for r in before), *own, *(f"{r}:" for r in behind)]:
                digest.update(("\n" if lines else "").encode() + line.encode())
                lines += 1
        yield _arrow(done, schema)
    if key is not None:
        yield _arrow([{"key": key, "repaired_sha256": digest.hexdigest()}], schema)


def _key(conv_id: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


class Repair:
    """The parsed conversations: summaries, edits and repaired rows.

    ``turns`` is ``(conv_id, turn, role, text)``.
    """

    def __init__(self, turns: DataFrame) -> None:
        self.tables = Tables(turns.sparkSession)
        rows = turns.select(
            _key(F.col("conv_id")).alias("key"),
            F.col("turn").cast("long").alias("turn"),
            F.coalesce("role", F.lit(" ")).alias("role"),
            F.coalesce("text", F.lit(" ")).alias("text"),
        )
        # Repeated rows are alike, so any order of them will do.
        order = ["key", "turn", "role", "text", "_tie"]
        rows = rows.withColumn("_tie", F.monotonically_increasing_id())
        placed = rows.repartitionByRange(*map(F.col, order)).sortWithinPartitions(*order).drop("_tie")
        self.rows = self.tables.cut(placed.withColumn("at", F.monotonically_increasing_id()), "turns")

        firsts = self.rows.groupBy("key", "role", F.md5("text").alias("sum")).agg(F.min("at").alias("at"))
        firsts = firsts.select("at", F.lit(True).alias("is_first"))
        last = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
        initial = F.substring("role", 1, 1)
        judged = self.rows.select(
            "key",
            "at",
            "turn",
            F.when(initial.isin("s", "u", "a"), initial).otherwise("-").alias("initial"),
            last.alias("last"),
        ).join(firsts, "at", "left")
        fault = (
            F.when(F.col("last") == "", IS_BLANK)
            .when(F.col("is_first").isNull(), IS_DUPLICATE)
            .when(~F.col("last").isin(".", "!", "?"), IS_TRUNCATED)
            .otherwise(NO_FAULT)
        )
        judged = judged.select("key", "at", "turn", "initial", fault.alias("fault"))
        # A part of the order, about as long as any other, goes whole to one task. Narrow rows with
        # much work each: by number, so that adaptive execution leaves the tasks as many as they are.
        tasks = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        in_parts = judged.repartition(tasks, F.shiftright("at", _PART_BITS)).sortWithinPartitions("at")
        runs = in_parts.mapInArrow(_runs, _RUN)
        together = runs.repartition("key").sortWithinPartitions("key", "first")
        self.parsed = self.tables.cut(together.mapInArrow(_conversations, _PARSED), "parsed")

    def edits(self) -> DataFrame:
        """``(key, at, before, edit, new_role, behind)``: one row per row."""
        return self.parsed.select("key", "first", "initials", "state", "edits").mapInArrow(_row_edits, _EDITS)

    def repaired(self) -> DataFrame:
        """``(key, at, role, text)``: the repaired lines of each conversation, in a list per row."""
        def empty(roles: str) -> Column:
            return F.transform(roles, lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))

        own = F.struct(F.coalesce("new_role", "role").alias("role"), F.col("text").alias("text"))
        kept = F.when(F.col("edit") == "D", F.expr("CAST(array() AS array<struct<role: string, text: string>>)"))
        lines = F.concat(empty("before"), kept.otherwise(F.array(own)), empty("behind"))
        joined = self.rows.join(self.edits().drop("key"), "at")
        return joined.select("key", "at", F.posexplode(lines).alias("line", "_")).select("key", "at", "line", "_.*")

    def hashes(self) -> DataFrame:
        """``(key, repaired_sha256)`` of the lines ``role:text``, joined by line feeds."""
        names = ["key", "at", "role", "text", "before", "edit", "new_role", "behind"]
        edits = self.edits().withColumns({"role": F.lit(None).cast("string"), "text": F.lit(None).cast("string")})
        none = {c: F.lit(None).cast("string") for c in ("edit", "new_role")}
        none |= {c: F.lit(None).cast("array<string>") for c in ("before", "behind")}
        both = self.rows.withColumns(none).select(names).unionByName(edits.select(names))
        in_order = both.repartition("key").sortWithinPartitions("key", "at", F.col("edit").isNull())
        return in_order.drop("at").mapInArrow(_hashes, "key string, repaired_sha256 string")

    def summary(self) -> DataFrame:
        """One row per conversation: faults, cost, audit and the hash of the repaired text."""
        sums = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        return self.parsed.where("whole").select("key", *sums).join(self.hashes(), "key")


def repair(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)``.

    One row per conv_id of ``conversations`` (of ``turns``, if not given); those without turns
    have zeros, an empty audit and the hash of nothing.
    """
    ids = (turns if conversations is None else conversations).select("conv_id").distinct()
    found = Repair(turns).summary()
    joined = ids.withColumn("key", _key(F.col("conv_id"))).join(found, "key", "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Faults put into a table of turns, each by what the CRC-32 of ``conv_id:turn`` leaves of 20."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    rows = turns.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), kind.alias("_kind"))
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", ""))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    changed = rows.where("_kind <> 0").withColumns({"text": text.otherwise(F.col("text")), "role": role})
    return changed.withColumn("_copy", F.explode(copies)).drop("_copy", "_kind")

"""Approximate nearest neighbours by cross-polytope hashing.

Nearest means largest inner product. Vectors are scaled to unit length for hashing; where lengths
differ, one more coordinate brings every item to the same length, so that the largest product is
the smallest angle. A table turns the unit vectors by a pseudo-rotation (random signs and a fast
Hadamard transform, three times) and gives each to the signed axis it is nearest to. A query is
looked up in every table, at its nearest axis and at the next nearest ones (multiprobe): at
``PROBES`` axes at least, and on until these hold ``PROBE_ROWS`` items. What it meets is ranked by
the exact product of the original vectors.

Buckets of any size stay whole. One that holds more than ``SPLIT_ROWS`` items is hashed again
about its own centre, which parts even vectors that are nearly alike; what is in one cell after
that is compared in blocks of bounded size, any number of tasks to a cell. Equal vectors are one
item, of which no query needs more than its k + 1 lowest ids (every copy has the same product), so
a vector that a third of all rows hold costs no more than another.

Each table needs a copy of every vector, once; each query travels to the cells it probes; what
leaves a block is k rows per query. What is sent to all tasks has a fixed size: counts per axis,
and centres of buckets that were split, of which there are at most ``TABLES`` times the axes.

Defined results: vectors that are null, zero, or hold a null, NaN or infinity take no part, nor do
those of another length than most (the longer, if two are as frequent); rows of one vec_id are
one item with several vectors, of which the best counts, and never meet themselves; null ids take
no part; with fewer than k others a query gets all; an empty table gives an empty table; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.shared import Tables

K = 20
TABLES = 16
PROBES = 5
PROBE_ROWS = 512
SPLIT_ROWS = 65_536
SPLIT_PROBES = 8
# Items and queries of a block.
BLOCK_ITEMS, BLOCK_QUERIES = 8_192, 1_024
SEED = 20

# Lengths count as equal up to this; then no coordinate is added.
_SAME_LENGTH = 1e-3


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of every row, whose length is a power of two, kept at length.

    Steps of doubling width, taken a few at a time as one small product.
    """
    n, d = x.shape
    width = 1
    while width < d:
        step = min(8, d // width)
        small = np.ones((1, 1), x.dtype)
        while len(small) < step:
            small = np.block([[small, small], [small, -small]])
        x = np.matmul(small, x.reshape(n, d // (width * step), step, width)).reshape(n, d)
        width *= step
    return x / np.sqrt(d).astype(x.dtype)


def signs(seed: int, tables: int, axes: int) -> np.ndarray:
    """Three rows of random signs for each table."""
    return np.random.default_rng(seed).choice(np.array([-1, 1], "f4"), size=(tables, 3, axes))


def turned(x: np.ndarray, flips: np.ndarray) -> np.ndarray:
    for row in flips:
        x = hadamard(x * row)
    return x


def signed_axes(x: np.ndarray) -> np.ndarray:
    """Scores of all 2 d signed axes: coordinate i is axis 2 i, its opposite 2 i + 1."""
    return np.stack([x, -x], axis=2).reshape(len(x), -1)


def nearest_axis(x: np.ndarray) -> np.ndarray:
    at = np.abs(x).argmax(axis=1)
    return 2 * at + (x[np.arange(len(x)), at] < 0)


class Space(NamedTuple):
    """How vectors become unit vectors: their length, kind, longest norm and hashed coordinates."""

    length: int
    kind: str
    longest: float
    lifted: bool

    @property
    def axes(self) -> int:
        return 1 << (self.length + self.lifted - 1).bit_length()

    def vectors(self, column: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), self.kind).reshape(len(column), self.length)

    def items(self, v: np.ndarray) -> np.ndarray:
        """Unit vectors to be found."""
        out = np.zeros((len(v), self.axes), "f4")
        v = v.astype("f8") / self.longest
        if self.lifted:
            out[:, self.length] = np.sqrt(np.maximum(0, 1 - (v * v).sum(axis=1)))
        else:
            v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
        out[:, : self.length] = v
        return out

    def queries(self, v: np.ndarray) -> np.ndarray:
        """Unit vectors to look for."""
        out = np.zeros((len(v), self.axes), "f4")
        v = v.astype("f8") / self.longest
        out[:, : self.length] = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
        return out


def _packed(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes in their own type."""
    for batch in batches:
        lists = batch.column("v")
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind)
        # Zero and minus zero are one number.
        flat = flat + np.zeros(1, kind)
        width = flat.itemsize
        ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]) * width
        raw = pa.Array.from_buffers(
            pa.binary(), len(lists), [None, pa.py_buffer(ends.astype("i4").tobytes()), pa.py_buffer(flat.tobytes())]
        )
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), raw], names=["vec_id", "v"])


class Split(NamedTuple):
    """Buckets hashed again: their numbers (table * 2 axes + axis), ascending, and centres."""

    buckets: np.ndarray
    centres: np.ndarray

    def of(self, buckets: np.ndarray) -> np.ndarray:
        """The place of each bucket among those split, or -1."""
        if not len(self.buckets):
            return np.full(len(buckets), -1)
        at = np.minimum(np.searchsorted(self.buckets, buckets), len(self.buckets) - 1)
        return np.where(self.buckets[at] == buckets, at, -1)


class Hashing(NamedTuple):
    """What tasks need to hash: the space, signs of both levels, split buckets."""

    space: Space
    first: np.ndarray
    second: np.ndarray
    split: Split

    @property
    def signed(self) -> int:
        return 2 * self.space.axes

    def second_turn(self, table: int, places: np.ndarray, x: np.ndarray) -> np.ndarray:
        return turned(x - self.split.centres[places], self.second[table])

    def cells(self, x: np.ndarray, table: int) -> np.ndarray:
        """The cell of each item in a table: bucket, and axis about its centre if it was split."""
        bucket = table * self.signed + nearest_axis(turned(x, self.first[table]))
        cell = bucket * (self.signed + 1)
        places = self.split.of(bucket)
        again = np.flatnonzero(places >= 0)
        if len(again):
            cell[again] += 1 + nearest_axis(self.second_turn(table, places[again], x[again]))
        return cell


def _sums(sent):
    """Per task and bucket: items and the sum of their unit vectors."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h: Hashing = sent.value
        tables = len(h.first)
        counts = np.zeros(tables * h.signed, "i8")
        sums = np.zeros((tables * h.signed, h.space.axes))
        for batch in batches:
            x = h.space.items(h.space.vectors(batch.column("v"))) if len(batch) else np.zeros((0, h.space.axes), "f4")
            for t in range(tables):
                bucket = h.cells(x, t) // (h.signed + 1)
                order = np.argsort(bucket, kind="stable")
                found, first, n = np.unique(bucket[order], return_index=True, return_counts=True)
                counts[found] += n
                if len(found):
                    sums[found] += np.add.reduceat(x[order].astype("f8"), first, axis=0)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held), pa.array(counts[held]), pa.array(list(sums[held]), pa.list_(pa.float64()))],
            names=["bucket", "n", "sums"],
        )

    return scan


def _placed(sent, with_vectors: bool):
    """Every item in the cell it has in each table."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h: Hashing = sent.value
        for batch in batches:
            if not len(batch):
                continue
            x = h.space.items(h.space.vectors(batch.column("v")))
            for t in range(len(h.first)):
                cells = pa.array(h.cells(x, t))
                if with_vectors:
                    columns, names = [cells, batch.column("v"), batch.column("ids")], ["cell", "v", "ids"]
                else:
                    found, n = np.unique(cells.to_numpy(), return_counts=True)
                    columns, names = [pa.array(found), pa.array(n)], ["cell", "n"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return scan


def _until(scores: np.ndarray, counts: np.ndarray, least: int, rows: int) -> np.ndarray:
    """Which axes each query probes: the nearest ``least``, and on until they hold ``rows`` items."""
    order = np.argsort(-scores, axis=1, kind="stable")
    before = np.cumsum(counts[order], axis=1) - counts[order]
    wanted = (np.arange(scores.shape[1]) < least) | (before < rows)
    out = np.zeros(scores.shape, bool)
    np.put_along_axis(out, order, wanted, axis=1)
    return out & (counts > 0)


class Probing(NamedTuple):
    hashing: Hashing
    cells: np.ndarray
    counts: np.ndarray
    probes: int
    split_probes: int
    rows: int

    def per_axis(self, first: int, n: int) -> np.ndarray:
        """Items in ``n`` cells from ``first`` on."""
        out = np.zeros(n, "i8")
        low, high = np.searchsorted(self.cells, [first, first + n])
        out[self.cells[low:high] - first] = self.counts[low:high]
        return out


def _probed(sent):
    """Every query at the cells it probes."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Probing = sent.value
        h = p.hashing
        each = h.signed + 1
        for batch in batches:
            for at in range(0, len(batch), 2_048):
                part = batch.slice(at, 2_048)
                x = h.space.queries(h.space.vectors(part.column("v")))
                rows, cells = [], []
                for t in range(len(h.first)):
                    all_cells = p.per_axis(t * h.signed * each, h.signed * each).reshape(h.signed, each)
                    wanted = _until(signed_axes(turned(x, h.first[t])), all_cells.sum(axis=1), p.probes, p.rows)
                    query, axis = np.nonzero(wanted)
                    bucket = t * h.signed + axis
                    places = h.split.of(bucket)
                    whole = places < 0
                    rows.append(query[whole])
                    cells.append(bucket[whole] * each)
                    for b in np.unique(bucket[~whole]):
                        mine = query[bucket == b]
                        place = np.full(len(mine), h.split.of(np.array([b]))[0])
                        scores = signed_axes(h.second_turn(t, place, x[mine]))
                        inner = _until(scores, all_cells[b - t * h.signed, 1:], p.split_probes, p.rows)
                        q, c = np.nonzero(inner)
                        rows.append(mine[q])
                        cells.append(b * each + 1 + c)
                row = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(cells)), part.column("vec_id").take(row), part.column("v").take(row)],
                    names=["cell", "query_id", "q"],
                )

    return scan


def exact_scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products row by row in double precision, the same for the same two vectors."""
    return (q.astype("f8") * v.astype("f8")).sum(axis=1)


def _best(space: Space, k: int):
    """The k best of a block for each of its queries, by exact product, then id."""

    def compare(queries: pa.Table, items: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(queries) and len(items):
            queries, items = queries.combine_chunks(), items.combine_chunks()
            q = space.vectors(queries.column("q").chunk(0)).astype("f8")
            v = space.vectors(items.column("v").chunk(0)).astype("f8")
            lists = items.column("ids").chunk(0)
            bounds, ids = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten().to_numpy()
            own = queries.column("query_id").to_numpy()
            most = max(1, (1 << 21) // len(v))
            for at in range(0, len(q), most):
                rough = q[at : at + most] @ v.T
                if len(v) > k + 1:
                    # An item whose only id is the query's own may be among the first k.
                    edge = -np.partition(-rough, k, axis=1)[:, k]
                else:
                    edge = rough.min(axis=1)
                # Slack for the order of summation; what is within it is scored again.
                size = np.abs(q[at : at + most]).sum(axis=1) * np.abs(v).max()
                edge = np.where(np.isfinite(size), edge - 1e-13 * size, -np.inf)
                r, c = np.nonzero(~(rough < edge[:, None]))
                score = exact_scores(q[at + r], v[c])
                n = np.diff(bounds)[c]
                flat = np.arange(n.sum()) + np.repeat(bounds[c] - np.cumsum(n) + n, n)
                row, vec, score = np.repeat(r, n), ids[flat], np.repeat(score, n)
                other = vec != own[at + row]
                row, vec, score = row[other], vec[other], score[other]
                order = np.lexsort((vec, -score, row))
                row, vec, score = row[order], vec[order], score[order]
                nth = np.arange(len(row)) - np.searchsorted(row, row)
                kept = nth < k
                out["query_id"].append(own[at + row[kept]])
                out["vec_id"].append(vec[kept])
                out["score"].append(score[kept])
        kinds = {"query_id": "i8", "vec_id": "i8", "score": "f8"}
        return pa.table({c: np.concatenate([np.zeros(0, kinds[c]), *x]) for c, x in out.items()})

    return compare


def _space(rows: DataFrame, kind: str) -> Space | None:
    """From one row per vector length: the most frequent length, and its least and longest norm."""
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    norms = rows.select(F.size("v").alias("length"), F.sqrt(squares).alias("norm")).groupBy("length")
    found = norms.agg(F.count(F.lit(1)).alias("n"), F.min("norm").alias("least"), F.max("norm").alias("longest"))
    first = found.orderBy(F.desc("n"), F.desc("length")).first()
    if first is None:
        return None
    lifted = first["least"] < first["longest"] * (1 - _SAME_LENGTH)
    return Space(first["length"], kind, first["longest"], lifted)


def usable(v: Column) -> Column:
    """Whether a vector can take part: not null, not zero, every component a finite number."""
    wrong = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~wrong & F.exists(v, lambda x: x != 0), F.lit(False))


def nearest(
    vectors: DataFrame,
    is_query: Column | str,
    k: int = K,
    tables: int = TABLES,
    probes: int = PROBES,
    probe_rows: int = PROBE_ROWS,
    split_rows: int = SPLIT_ROWS,
    split_probes: int = SPLIT_PROBES,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest found for each query, from rank 1.

    ``vectors`` is ``(vec_id, embedding)``; the condition ``is_query`` tells the queries by vec_id.
    """
    spark, kept = vectors.sparkSession, Tables(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    kind = "<f4" if "float" in rows.schema["v"].dataType.simpleString() else "<f8"
    space = _space(rows, kind)
    if space is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = rows.where(F.size("v") == space.length)
    packed = rows.mapInArrow(lambda batches: _packed(batches, kind), "vec_id bigint, v binary")
    # Of equal vectors the k + 1 lowest ids; a task's own copies meet before they are dealt out.
    lowest = F.dense_rank().over(Window.partitionBy("v", "_salt").orderBy("vec_id"))
    salted = packed.withColumn("_salt", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
    some = salted.withColumn("_nth", lowest).where(F.col("_nth") <= k + 1).select("vec_id", "v")
    lowest = F.dense_rank().over(Window.partitionBy("v").orderBy("vec_id"))
    some = some.withColumn("_nth", lowest).where(F.col("_nth") <= k + 1)
    items = kept.cut(some.groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")), "items")
    queries = packed.where(is_query)

    first, second = signs(SEED, tables, space.axes), signs(SEED + 1, tables, space.axes)
    none = Split(np.zeros(0, "i8"), np.zeros((0, space.axes), "f4"))
    send = spark.sparkContext.broadcast
    hashing = Hashing(space, first, second, none)
    sums = items.mapInArrow(_sums(send(hashing)), "bucket bigint, n bigint, sums array<double>")
    total = sums.groupBy("bucket").agg(F.sum("n").alias("n"), *[
        F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(space.axes)
    ])
    # At most one row per table and axis.
    large = total.where(F.col("n") > split_rows).orderBy("bucket").toArrow()
    if len(large):
        sums = np.stack([large.column(f"s{i}").to_numpy() for i in range(space.axes)], axis=1)
        centres = sums / large.column("n").to_numpy()[:, None]
        hashing = hashing._replace(split=Split(large.column("bucket").to_numpy(), centres.astype("f4")))
    sent = send(hashing)
    counted = items.mapInArrow(_placed(sent, False), "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    # At most one row per table, axis and axis within it.
    counted = kept.cut(counted, "cells")
    sizes = counted.orderBy("cell").toArrow()
    probing = Probing(hashing, sizes.column("cell").to_numpy(), sizes.column("n").to_numpy(), probes, split_probes, probe_rows)
    placed = items.mapInArrow(_placed(sent, True), "cell bigint, v binary, ids array<bigint>")
    asked = queries.mapInArrow(_probed(send(probing)), "cell bigint, query_id bigint, q binary")

    # A cell of many items or queries is a grid of blocks.
    asks = asked.groupBy("cell").agg(F.count(F.lit(1)).alias("m"))
    grid = kept.cut(
        counted.join(asks, "cell").select(
            "cell",
            F.ceil(F.col("n") / BLOCK_ITEMS).cast("int").alias("across"),
            F.ceil(F.col("m") / BLOCK_QUERIES).cast("int").alias("down"),
        ),
        "grid",
    )

    def dealt(df: DataFrame, mine: str, other: str, by: Column) -> DataFrame:
        at = F.pmod(F.xxhash64(by), F.col(mine)).cast("int").alias(mine[0])
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other[0])
        return df.join(F.broadcast(grid), "cell").select("cell", at, every, *[c for c in df.columns if c != "cell"])

    left = dealt(asked, "down", "across", F.col("query_id"))
    right = dealt(placed, "across", "down", F.get("ids", F.lit(0)))
    keys = ["cell", "a", "d"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _best(space, k), "query_id bigint, vec_id bigint, score double"
    )
    found = met.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

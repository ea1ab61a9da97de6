"""Near-duplicate documents by HyperMinHash sketches and exact confirmation.

A document is its set of distinct shingles of five words. Its sketch has 256 registers: a
shingle's hash names a register by its first bits, and the register keeps the least of the
rest in 16 bits, as the count of leading zeros and ten bits of mantissa. An empty register
takes over the value of another one, found along a random order of its own that is the same for
all documents, so small sets are sketched like large ones.

Registers are banded five at a time, 51 bands; two sets of similarity 0.75 miss all bands with
a chance of 1e-6. A band's members are candidates. Candidates pass the bound on sizes and the
estimate from their registers, corrected for registers that agree by chance, which is let in
from 0.15 (five standard deviations) below the threshold; then the full sets are compared. A set
of few shingles fills few registers and its estimate spreads further: pairs with a set of less
than 32 are compared in full without it.

Documents of equal sets are one class from the start. In a bucket of any size members are
first compared with one of them only, the one that meets most others: what that joins needs no
further pairs. Of buckets that still hold several components, small ones compare their members;
large ones go by their members' rarest shingles (see ``_by_shingles``), which loses no link
either and does not form the pairs of a group that merely shares a long passage.

Defined results: texts without words, null ones too, are linked with nothing; a row without
doc_id takes part but cannot name a component; repeated rows fall in one class; an empty table
gives an empty table; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.graph import components
from weftline.llm.membership import KeyFilter, key_filter
from weftline.llm.rows import with_rows, without_rows
from weftline.llm.word_hashes import NOT_BLANK, Words, blocks, grams, mix, words
from weftline.shared import Tables

SHINGLE = 5
SIMILAR = 75  # per cent

REGISTERS = 256
MANTISSA = 10
BAND = 5
BANDS = REGISTERS // BAND
MARGIN = 0.15

# Sets of fewer shingles than this are compared without an estimate.
SMALL = 32

# Members of a bucket, or of a shingle, that are few enough to be compared with each other.
FEW = 16

# Sets and shingles that a task compares at once.
BLOCK_ROWS = 512
SHINGLES_AT_ONCE = 4096


class Sets(NamedTuple):
    """Sorted distinct shingles of some rows, and where each row's begin."""

    shingles: np.ndarray
    bounds: np.ndarray


def shingle_sets(found: Words) -> Sets:
    """Distinct shingles per row; a row of fewer words has its whole sequence as one."""
    counts, rows = found.counts, found.rows
    hashes, inside = grams(found, SHINGLE)
    owner, values = rows[: len(hashes)][inside], hashes[inside]
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        whole = np.zeros(len(short), "u8")
        for j in range(SHINGLE - 1):
            longer = counts[short] > j
            word = found.hashes[found.bounds[short[longer]] + j]
            whole[longer] = mix(whole[longer] + word + np.uint64(j + 1))
        owner, values = np.concatenate([owner, short]), np.concatenate([values, whole])
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
    bounds = np.searchsorted(owner[fresh], np.arange(len(counts) + 1))
    return Sets(values[fresh], bounds)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, "u8"), np.cumsum(values, dtype="u8")])
    return total[bounds[1:]] - total[bounds[:-1]]


def set_keys(sets: Sets) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that tell sets apart: two sums of differently mixed shingles."""
    high = mix(_sums(mix(sets.shingles ^ np.uint64(0xA5)), sets.bounds))
    return high, mix(_sums(mix(sets.shingles ^ np.uint64(0x5A5A)), sets.bounds))


def _orders() -> np.ndarray:
    """Per register an order of all registers, the same in every process."""
    rng = np.random.Generator(np.random.PCG64(20))
    return np.argsort(rng.random((REGISTERS, REGISTERS)), axis=1).astype("i2")


_ORDERS = _orders()
_EMPTY = np.uint64((1 << 64) - 1)


def sketches(sets: Sets) -> np.ndarray:
    """(rows, 256) registers as 16-bit codes that rise with the value they stand for."""
    n = len(sets.bounds) - 1
    rows = np.repeat(np.arange(n), np.diff(sets.bounds))
    mixed = mix(sets.shingles + np.uint64(0x9E3779B97F4A7C15))
    register = (mixed >> np.uint64(56)).astype("i8")
    least = np.full(n * REGISTERS, _EMPTY, "u8")
    np.minimum.at(least, rows * REGISTERS + register, (mixed << np.uint64(8)) >> np.uint64(8))
    least = least.reshape(n, REGISTERS)
    empty = least == _EMPTY
    part, exponent = np.frexp((least & np.uint64((1 << 56) - 1)).astype("f8") + 1.0)
    codes = (exponent.astype("i4") << MANTISSA) + ((part - 0.5) * (2 << MANTISSA)).astype("i4")
    codes = codes.astype("u2")
    row, place = np.nonzero(empty & ~empty.all(axis=1)[:, None])
    for step in range(REGISTERS):
        if not len(row):
            break
        source = _ORDERS[place, step]
        full = ~empty[row, source]
        codes[row[full], place[full]] = codes[row[full], source[full]]
        row, place = row[~full], place[~full]
    return codes


def band_keys(codes: np.ndarray) -> np.ndarray:
    """(rows, 51) bucket keys, each of five neighbouring registers and the band's number."""
    taken = codes[:, : BANDS * BAND].astype("u8").reshape(len(codes), BANDS, BAND)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype="u8"), taken.shape[:2]).copy()
    for j in range(BAND):
        out = mix(out * np.uint64(0x2545F4914F6CDD1D) + taken[:, :, j])
    return out


def chance(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Share of registers of two disjoint sets of these sizes that agree by chance.

    A register's least value is about exponential with the set's load; cells of exponent e are
    2^-(e + 1 + MANTISSA) wide. Sums of density times density times width over all exponents.
    """
    a = np.maximum(left, 1)[:, None] / REGISTERS
    b = np.maximum(right, 1)[:, None] / REGISTERS
    e = np.arange(0, 48)[None, :]
    x = 0.75 * 2.0**-e
    return (a * b * 4.0 ** -(e + 1) * np.exp(-(a + b) * x)).sum(axis=1) / (1 << MANTISSA)


def estimate(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    by_chance = chance(n_left, n_right)
    return ((left == right).mean(axis=1) - by_chance) / (1 - by_chance)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view("i8"))


_SKETCHED = "doc_id bigint, mark bigint, n bigint, high bigint, low bigint, sketch binary"


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch.column("text")):
            sets = shingle_sets(words(block, NOT_BLANK))
            high, low = set_keys(sets)
            codes = sketches(sets)
            raw = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(2 * REGISTERS), len(codes), [None, pa.py_buffer(codes.tobytes())]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.select(["doc_id", "mark"]).slice(block.first, block.rows).columns,
                    pa.array(np.diff(sets.bounds)),
                    _signed(high),
                    _signed(low),
                    raw.cast(pa.binary()),
                ],
                names=["doc_id", "mark", "n", "high", "low", "sketch"],
            )


def _stack(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "u2").reshape(-1, REGISTERS)


def _bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 4096):
            part = batch.slice(at, 4096)
            keys = band_keys(_stack(part.column("sketch")))
            nodes = np.repeat(part.column("node").to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays(
                [_signed(keys.reshape(-1)), pa.array(nodes)], names=["bucket", "node"]
            )


def _promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
        if not len(n_a):
            continue
        likeness = estimate(_stack(batch.column("sketch_a")), _stack(batch.column("sketch_b")), n_a, n_b)
        keep = pa.array((likeness >= SIMILAR / 100 - MARGIN) | (np.minimum(n_a, n_b) < SMALL))
        yield batch.select(["a", "b", "n_a", "n_b"]).filter(keep)


def _wanted_sets(wanted: KeyFilter):
    """Shingles of the sets that pass the filter, each once per task."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple[int, int]] = set()
        for batch in batches:
            for block in blocks(batch.column("text")):
                sets = shingle_sets(words(block, NOT_BLANK))
                high, low = set_keys(sets)
                take = []
                for i in np.flatnonzero(wanted.passes(high)).tolist():
                    key = (int(high[i]), int(low[i]))
                    if key not in sent and sets.bounds[i] < sets.bounds[i + 1]:
                        sent.add(key)
                        take.append(i)
                if not take:
                    continue
                parts = [sets.shingles[sets.bounds[i] : sets.bounds[i + 1]] for i in take]
                ends = np.cumsum([0, *map(len, parts)])
                lists = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), _signed(np.concatenate(parts))
                )
                yield pa.RecordBatch.from_arrays(
                    [_signed(high[take]), _signed(low[take]), lists], names=["high", "low", "shingles"]
                )

    return scan


def _sets(members: DataFrame, classes: DataFrame, docs: DataFrame, tables: Tables) -> DataFrame:
    """``(node, shingles)`` of all classes that share a bucket, as a written table.

    The texts are read again for this; sets that share no bucket do not leave their task.
    """
    nodes = members.select("node").distinct()
    named = classes.join(nodes, "node", "left_semi").select("node", "high", "low")
    named = tables.cut(named, "named", classes.count())
    texts = docs.select("text").mapInArrow(
        _wanted_sets(key_filter(named, "high")), "high bigint, low bigint, shingles array<bigint>"
    )
    sets = texts.join(named, ["high", "low"]).groupBy("node").agg(F.first("shingles").alias("shingles"))
    sets = tables.cut(sets, "sets")
    tables.drop(named)
    return sets


def _confirm(pairs: DataFrame, classes: DataFrame, sets: DataFrame, tables: Tables) -> DataFrame:
    """The pairs ``(a, b)`` that pass sizes, estimate and full comparison, as a written table."""

    def side(x: str) -> DataFrame:
        return classes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))

    def members(x: str) -> DataFrame:
        return sets.select(F.col("node").alias(x), F.col("shingles").alias(f"of_{x}"))

    n = pairs.count()
    sized = pairs.join(side("a"), "a").join(side("b"), "b")
    near = F.least("n_a", "n_b") * 100 >= SIMILAR * F.greatest("n_a", "n_b")
    likely = tables.cut(
        sized.where(near).mapInArrow(_promising, "a bigint, b bigint, n_a bigint, n_b bigint"), "likely", n
    )
    compared = likely.join(members("b"), "b").join(members("a"), "a")
    common = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    linked = compared.where(100 * common >= SIMILAR * (F.col("n_a") + F.col("n_b") - common))
    links = tables.cut(linked.select("a", "b"), "links", likely.count())
    tables.drop(likely)
    return links


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _roots_of(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return members.withColumn("root", F.col("node"))
    return members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _chosen(members: DataFrame, *by: str) -> DataFrame:
    """``(*by, pivot)``: per group the member that meets most others over all its buckets.

    The text a group of near copies was made from is in more of their buckets than any copy,
    and is near copies that are not near each other.
    """
    meets = members.groupBy("node").agg(F.sum("size").alias("meets"))
    best = F.max(F.struct("meets", (-F.col("node")).alias("minus")))
    chosen = members.join(meets, "node").groupBy(*by).agg(best.alias("p"))
    return chosen.select(*by, (-F.col("p.minus")).alias("pivot"))


def _class_components(classes: DataFrame, docs: DataFrame, tables: Tables) -> DataFrame:
    """``(node, root)`` for the classes linked with another one."""
    n_classes = classes.count()
    banded = classes.select("node", "sketch").mapInArrow(_bucketed, "bucket bigint, node bigint")
    sizes = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = tables.cut(banded.join(sizes, "bucket"), "members", n_classes * BANDS)
    sets = _sets(members, classes, docs, tables)
    n_members = members.count()
    met = members.join(_chosen(members, "bucket"), "bucket").where("pivot <> node")
    pairs = met.select(*_ordered(F.col("pivot"), F.col("node"))).distinct()
    tested = [tables.cut(pairs, "tested", n_members)]
    links = [_confirm(tested[0], classes, sets, tables)]
    roots = components(links[0], tables)
    placed = _roots_of(members.select("bucket", "node"), roots)
    mixed = placed.groupBy("bucket").agg(
        F.min("root").alias("_lo"), F.max("root").alias("_hi"), F.count(F.lit(1)).alias("size")
    )
    left = placed.join(mixed.where("_lo < _hi").select("bucket", "size"), "bucket")
    left = tables.cut(left, "left", n_members)
    small = left.where(F.col("size") <= FEW)
    fresh = _apart(small, small, "bucket")
    large = left.where(F.col("size") > FEW)
    core = None
    if not large.isEmpty():
        rare, core = _by_shingles(large, classes, sets, tables)
        stars = core.where("rep <> node AND root <> rep_root").select(*_ordered(F.col("rep"), F.col("node")))
        fresh = fresh.unionByName(rare).unionByName(stars)
    fresh = fresh.distinct().join(tested[0], ["a", "b"], "left_anti")
    tested.append(tables.cut(fresh, "tested", left.count() * FEW))
    links.append(_confirm(tested[1], classes, sets, tables))
    if core is not None:
        links.append(_between_cores(large, _compared_further(core, links[1]), sets, tables))
    tables.drop(roots, left, core)
    roots = components(reduce(DataFrame.unionByName, links), tables)
    tables.drop(members, sets, *tested, *links)
    return roots


def _apart(one: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Pairs ``(a, b)`` of nodes that share ``key`` and lie in different components."""
    left = one.select(key, F.col("node").alias("a"), F.col("root").alias("root_a"))
    right = other.select(key, F.col("node").alias("b"), F.col("root").alias("root_b"))
    return left.join(right, key).where("a < b AND root_a <> root_b").select("a", "b")


def _linked_blocks(one: pa.Table, other: pa.Table) -> pa.Table:
    """Linked pairs of different components between two blocks, by their full sets."""
    names = ["a", "b"]
    if not len(one) or not len(other):
        return pa.table({n: pa.array([], pa.int64()) for n in names})
    sides = []
    for t in (one, other):
        lists = t.column("shingles").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        sides.append((t.column("node").to_numpy(), t.column("root").to_numpy(), sizes, lists.flatten().to_numpy()))
    (p, p_root, n, x), (q, q_root, m, y) = sides
    both = np.intersect1d(x, y)
    common = np.zeros((len(p), len(q)), "f4")
    rows_x, rows_y = np.repeat(np.arange(len(p)), n), np.repeat(np.arange(len(q)), m)
    at_x, at_y = np.searchsorted(both, x), np.searchsorted(both, y)
    in_x = (at_x < len(both)) & (both[np.minimum(at_x, len(both) - 1)] == x) if len(both) else np.zeros(len(x), bool)
    in_y = (at_y < len(both)) & (both[np.minimum(at_y, len(both) - 1)] == y) if len(both) else np.zeros(len(y), bool)
    rows_x, at_x, rows_y, at_y = rows_x[in_x], at_x[in_x], rows_y[in_y], at_y[in_y]
    for first in range(0, len(both), SHINGLES_AT_ONCE):
        width = min(SHINGLES_AT_ONCE, len(both) - first)
        of = []
        for rows, at, count in ((rows_x, at_x, len(p)), (rows_y, at_y, len(q))):
            here = (at >= first) & (at < first + width)
            held = np.zeros((count, width), "f4")
            held[rows[here], at[here] - first] = 1
            of.append(held)
        common += of[0] @ of[1].T
    linked = 100 * common >= SIMILAR * (n[:, None] + m[None, :] - common)
    i, j = np.nonzero(linked & (p_root[:, None] != q_root[None, :]))
    return pa.table({"a": np.minimum(p[i], q[j]), "b": np.maximum(p[i], q[j])})


def _compared_further(core: DataFrame, links: DataFrame) -> DataFrame:
    """``(node)``: the smallest set of each group, and those not joined to their group's.

    Take linked x and y without a common rare shingle. The smallest set of y's group is no larger
    than y and has the same frequent shingles, so it links with x too; likewise for y and x. So
    each of the two is joined to its group's smallest set or compared here, and is linked with
    the other or with the other's smallest set, or those two are linked.
    """
    stars = core.where("rep <> node AND root <> rep_root")
    pairs = stars.select("node", *_ordered(F.col("rep"), F.col("node")))
    loose = pairs.join(links, ["a", "b"], "left_anti").select("node")
    return core.where("rep = node").select("node").unionByName(loose)


def _between_cores(large: DataFrame, chosen: DataFrame, sets: DataFrame, tables: Tables) -> DataFrame:
    """Links between the ``chosen`` nodes of large buckets, as a written table.

    These are sets of one family, nearly all frequent shingles and each a little different, in
    components that one comparison with the family's centre has not joined. Whether they link
    only their full sets tell. A family, what shares large buckets, is cut into blocks, and a
    task compares two blocks as matrices of set bits: it holds no more than these and sends
    links only.
    """
    reps = tables.cut(large.join(chosen, "node", "left_semi"), "reps")
    hubs = reps.groupBy("bucket").agg(F.min("node").alias("b"))
    family = components(reps.join(hubs, "bucket").select(F.col("node").alias("a"), "b"), tables)
    several = reps.select("node", "root").distinct().join(family.withColumnRenamed("root", "family"), "node")
    # A family within one component has nothing left to compare.
    sizes = several.groupBy("family").agg(
        F.count(F.lit(1)).alias("n"), F.min("root").alias("_lo"), F.max("root").alias("_hi")
    )
    sizes = sizes.where("_lo < _hi").select("family", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"))
    placed = several.join(sizes, "family").withColumn("own", F.expr("CAST(pmod(xxhash64(node), blocks) AS INT)"))
    members = tables.cut(placed.join(sets, "node"), "families")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = members.select("family", "node", "root", "shingles", "own", every.alias("with"))
    one = spread.where("own <= with").select("family", F.col("own").alias("x"), F.col("with").alias("y"), "node", "root", "shingles")
    other = spread.where("with <= own").select("family", F.col("with").alias("x"), F.col("own").alias("y"), "node", "root", "shingles")
    keys = ["family", "x", "y"]
    found = one.groupBy(*keys).cogroup(other.groupBy(*keys)).applyInArrow(_linked_blocks, "a bigint, b bigint")
    links = tables.cut(found.distinct(), "links")
    tables.drop(family, members, reps)
    return links


def _by_shingles(
    large: DataFrame, classes: DataFrame, sets: DataFrame, tables: Tables
) -> tuple[DataFrame, DataFrame]:
    """What members of large buckets must be compared with, without forming their pairs.

    Sets of similarity t share a shingle among the n - ceil(t n) + 1 rarest of each. Shingles
    of at most ``FEW`` members are rare: sharing one among those makes a pair. What is left are
    sets whose rarest shingles reach into the frequent ones, the ``core``: without a common
    rare shingle two of them have exactly their frequent shingles in common. With equal
    frequent shingles the smallest set is the most similar to every other, so each is compared
    with that one (and see ``_compared_further``).

    Gives the rare pairs and ``(node, root, rep, rep_root)`` of the core.
    """
    nodes = large.select("node", "root").distinct()
    sized = classes.select("node", "n").join(nodes, "node")
    taken = F.col("n") - F.floor((3 * F.col("n") + 3) / 4) + 1
    shingles = sets.join(nodes, "node").select("node", "root", F.explode("shingles").alias("s"))
    counts = shingles.groupBy("s").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    shared = tables.cut(shingles.join(counts, "s"), "shared")
    often = F.col("f") > FEW
    of_node = shared.groupBy("node").agg(
        F.count(F.lit(1)).alias("shared"),
        F.sum(often.cast("long")).alias("often"),
        F.bit_xor(F.when(often, F.xxhash64("s"))).alias("one"),
        F.bit_xor(F.when(often, F.xxhash64("s", F.lit(1)))).alias("two"),
    )
    of_node = tables.cut(sized.join(of_node, "node").withColumn("taken", taken), "shares")
    # The shingles of one set, rarest first; those of no other member come before them.
    order = F.row_number().over(Window.partitionBy("node").orderBy("f", "s"))
    rare = shared.where(~often).withColumn("nth", order)
    rare = rare.join(of_node.select("node", (F.col("taken") - F.col("n") + F.col("shared")).alias("most")), "node")
    rare = rare.where(F.col("nth") <= F.col("most"))
    pairs = tables.cut(_apart(rare, rare, "s").distinct(), "rare")
    heavy = of_node.where(F.col("n") - F.col("often") < F.col("taken"))
    least = heavy.groupBy("one", "two", "often").agg(F.min(F.struct("n", "node", "root")).alias("rep"))
    core = heavy.join(least, ["one", "two", "often"])
    core = core.select("node", "root", F.col("rep.node").alias("rep"), F.col("rep.root").alias("rep_root"))
    core = tables.cut(core, "core", nodes.count())
    tables.drop(shared, of_node)
    return pairs, core


def _grouped(docs: DataFrame, tables: Tables) -> DataFrame:
    """``(doc_id, mark, n, root, component)`` for every row; ``mark`` is a hash of its text.

    ``root`` is NULL for rows without words.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text"
    )
    sketched = tables.cut(texts.mapInArrow(_sketched, _SKETCHED), "sketched")
    first = sketched.where("n > 0").groupBy("high", "low", "n").agg(
        F.min("doc_id").alias("least"), F.first("sketch").alias("sketch")
    )
    classes = tables.cut(first.withColumn("node", F.monotonically_increasing_id()), "classes")
    roots = _class_components(classes, texts, tables)
    named = _roots_of(classes.select("high", "low", "node", "least"), roots)
    ids = named.groupBy("root").agg(F.min("least").alias("component"))
    named = tables.cut(named.join(ids, "root").select("high", "low", "root", "component"), "named")
    tables.drop(classes, roots)
    rows = sketched.select("doc_id", "mark", "n", "high", "low").join(named, ["high", "low"], "left")
    return rows.select("doc_id", "mark", "n", "root", "component")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``: every row of ``docs`` and its component.

    ``component_id`` is the least doc_id reachable over links; ``kept`` says that it is the
    row's own (or that the row has no doc_id to compare).
    """
    rows = _grouped(docs, Tables(docs.sparkSession))
    own = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return rows.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        own.alias("component_id"),
        F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component, with its columns as they came: the least doc_id's.

    Rows without words all stay. Of rows equal in doc_id and text one stays; rows without
    doc_id give way to rows with one.
    """
    tables = Tables(docs.sparkSession)
    rows = tables.cut(_grouped(docs, tables).where("root IS NOT NULL"), "grouped")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")
    stays = rows.groupBy("root").agg(F.min(order).alias("first"))
    stays = stays.select(F.col("first.doc_id").alias("_id"), F.col("first.mark").alias("_mark"))
    # By row and not by component, which may hold any share of all rows.
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    leaves = rows.select("doc_id", "mark").distinct().join(stays, same, "left_anti")
    kept = without_rows(docs, tables.cut(leaves, "leaves"))
    repeated = rows.groupBy("doc_id", "mark").count().where("count > 1").select("doc_id", "mark")
    repeated = tables.cut(repeated, "repeated")
    tables.drop(rows)
    if repeated.isEmpty():
        return kept
    again = with_rows(kept, repeated).dropDuplicates(["doc_id", "text"])
    return without_rows(kept, repeated).unionByName(again)

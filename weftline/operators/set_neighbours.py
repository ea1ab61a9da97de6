"""The k most similar sets of every set, exactly: a top-k self-join over inverted lists.

Elements are ranked from the rarest to the most frequent, and a set is the ascending list of its
elements' ranks. Two sets that share an element are found at the first they share, in the list of
that element. A set looks through the lists of its elements from the rarest on; what it has not
found before position p shares none of its first p elements, so its similarity is at most
(n - p) / n. Once a set's k-th best is above that it stops, which spares the longest lists. The
first round looks at the ``FIRST`` rarest elements, the second goes on from there under the bound
that the first round's k-th best gives.

Lists travel to tasks in groups, a set once per group; the sets travel whole, so that a task knows
a pair's exact similarity and whether it is the place to report it, and sends on k rows per set
and element at most. A list longer than ``LIST`` is cut into a grid of blocks, each a task's work.

Equal sets are one, with the lowest k + 1 of its members. Sets of more than ``LARGE`` elements,
of which there are few, never travel: their overlaps are counted by a plain join of elements.

Over few elements that most pairs share the lists spare nothing and meet a pair once for each
element it shares. There blocks of sets of similar size are compared whole instead, by products
of 0-1 matrices: first each with itself, then with the blocks whose sizes its k-th best allows.
Sets travel as bits, once per block they meet; blocks grow with the sets up to ``BLOCK_SETS``, and a
task takes them strip by strip. The second round sends on only what is not below a set's k-th
best of the first, and a set with more than k members, which are its nearest, searches for none.
Both ways are exact. Sets that are nearly alike, but not equal, are compared with each other inside tasks: that is
quadratic in such a family.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators.numbering import ordered_index
from weftline.operators.pairs import renewed
from weftline.shared import cut

FIRST = 6
LIST = 1_024
GROUP = 20_000
LARGE = 4_096
SALTS = 32

# Different elements up to which overlaps are counted as matrix products.
FEW_ELEMENTS = 512
# Sets of a block at most, where blocks are compared whole, and at least if there are enough of them
# for ``SIDE`` blocks.
BLOCK_SETS = 131_072
LEAST_BLOCK = 2_048
SIDE = 8
# Sets of a block taken at once against so many of another block.
_STRIP = 256
_AGAINST = 16_384
# Pairs of equal elements that a task holds at once.
_AT_ONCE = 1 << 21

_FOUND = "id bigint, other bigint, common bigint, n bigint, m bigint"


class _Sets:
    """Sets as one array of elements with bounds."""

    def __init__(self, table: pa.Table) -> None:
        column = table.column("set").combine_chunks()
        offsets = column.offsets.to_numpy()
        self.bounds = (offsets - offsets[0]).astype("i8")
        self.elements = column.flatten().to_numpy()
        self.ids = table.column("id").to_numpy()
        self.sizes = np.diff(self.bounds)

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``rows``, element) of all elements of some sets, by element."""
        n = self.sizes[rows]
        at = np.arange(n.sum()) + np.repeat(self.bounds[rows] - np.cumsum(n) + n, n)
        owner, element = np.repeat(np.arange(len(rows)), n), self.elements[at]
        order = np.argsort(element, kind="stable")
        return owner[order], element[order]


class _Pairs(NamedTuple):
    left: np.ndarray
    right: np.ndarray
    common: np.ndarray
    first: np.ndarray


def _overlaps(left: _Sets, rows: np.ndarray, right: _Sets, others: np.ndarray):
    """All pairs of sets that share an element: places, number shared, first one shared."""
    owner, element = left.entries(rows)
    other, theirs = right.entries(others)
    low, high = np.searchsorted(theirs, element, "left"), np.searchsorted(theirs, element, "right")
    matches = np.bincount(owner, weights=high - low, minlength=len(rows))
    part = np.cumsum(matches) // _AT_ONCE
    for k in np.unique(part):
        mine = part[owner] == k
        n, begin, own, of = (high - low)[mine], low[mine], owner[mine], element[mine]
        met = other[np.arange(n.sum()) + np.repeat(begin - np.cumsum(n) + n, n)]
        keys = np.repeat(own, n) * len(others) + met
        pair, first, common = np.unique(keys, return_index=True, return_counts=True)
        yield _Pairs(pair // len(others), pair % len(others), common, np.repeat(of, n)[first])


def _of_few_elements(left: _Sets, rows: np.ndarray, right: _Sets, others: np.ndarray, element: int) -> _Pairs | None:
    """The same for sets over few elements, as products of 0-1 matrices; pairs that share
    ``element`` first."""
    (owner, mine), (other, theirs) = left.entries(rows), right.entries(others)
    names = np.unique(np.concatenate([mine, theirs]))
    if len(names) > FEW_ELEMENTS:
        return None
    a, b = (np.zeros((len(x), len(names)), "f4") for x in (rows, others))
    a[owner, np.searchsorted(names, mine)] = 1
    b[other, np.searchsorted(names, theirs)] = 1
    k = int(np.searchsorted(names, element))
    i, j = np.nonzero(a[:, :k] @ b[:, :k].T == 0)
    return _Pairs(i, j, (a @ b.T)[i, j].astype("i8"), np.full(len(i), element))


def _best_in_lists(k: int):
    """Cogroup of probing sets (with positions ``lo`` to ``hi`` and a bound) and listed sets."""

    def compare(probing: pa.Table, listed: pa.Table) -> pa.Table:
        out: list[np.ndarray] = []
        if len(probing) and len(listed):
            left, right = _Sets(probing), _Sets(listed)
            lo, hi, group = (probing.column(c).to_numpy() for c in ("lo", "hi", "grp"))
            best, of = probing.column("best").to_numpy(), probing.column("of").to_numpy()
            groups, first_long = probing.column("groups")[0].as_py(), probing.column("long_from")[0].as_py()
            owner = np.repeat(np.arange(len(left.ids)), left.sizes)
            place = np.arange(len(owner)) - left.bounds[:-1][owner]
            here = _group_of(left.elements.astype("i8"), groups, first_long) == group[0]
            asked = here & (place >= lo[owner]) & (place < hi[owner])
            order = np.argsort(left.elements[asked], kind="stable")
            wanted, askers = left.elements[asked][order], owner[asked][order]
            r_owner = np.repeat(np.arange(len(right.ids)), right.sizes)
            r_order = np.argsort(right.elements, kind="stable")
            r_sorted, r_owner = right.elements[r_order], r_owner[r_order]
            elements, starts = np.unique(wanted, return_index=True)
            for element, a, b in zip(elements, starts, [*starts[1:], len(wanted)], strict=True):
                rows = askers[a:b]
                others = r_owner[slice(*np.searchsorted(r_sorted, [element, element + 1]))]
                if not len(others):
                    continue
                few = _of_few_elements(left, rows, right, others, element)
                for p in [few] if few is not None else _overlaps(left, rows, right, others):
                    u, v = rows[p.left], others[p.right]
                    union = left.sizes[u] + right.sizes[v] - p.common
                    # Not below the k-th best so far, compared as fractions.
                    keep = (p.first == element) & (left.ids[u] != right.ids[v])
                    keep &= p.common * of[u] >= best[u] * union
                    u, v, common, union = u[keep], v[keep], p.common[keep], union[keep]
                    order = np.lexsort((right.ids[v], -common / union, u))
                    u, v, common = u[order], v[order], common[order]
                    kept = np.arange(len(u)) - np.searchsorted(u, u) < k
                    u, v, common = u[kept], v[kept], common[kept]
                    out.append(np.stack([left.ids[u], right.ids[v], common, left.sizes[u], right.sizes[v]]))
        found = np.concatenate([np.zeros((5, 0), "i8"), *out], axis=1)
        return pa.table({c: pa.array(found[i]) for i, c in enumerate(("id", "other", "common", "n", "m"))})

    return compare


class _BitSets:
    """A block of sets as bits, in the order of size."""

    def __init__(self, block: pa.Table) -> None:
        block = block.sort_by([("n", "ascending"), ("id", "ascending")])
        self.ids, self.sizes = (block.column(c).to_numpy() for c in ("id", "n"))
        column = block.column("bits").combine_chunks()
        offsets = np.frombuffer(column.buffers()[1], "i4")[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2], "u1")[offsets[0] : offsets[-1]]
        self.bits = data.reshape(len(column), -1)
        self._tiles: dict[int, np.ndarray] = {}
        if "least" in block.column_names:
            self.least = block.column("least").to_numpy()

    def as_matrix(self, start: int, end: int) -> np.ndarray:
        """Sets ``start`` to ``end`` as rows of zeros and ones."""
        return np.unpackbits(self.bits[start:end], axis=1).astype("f4")

    def tile(self, start: int) -> np.ndarray:
        """Sets ``start`` to ``start + _AGAINST`` as rows, with a one and their size; made once."""
        if start not in self._tiles:
            y, m = self.as_matrix(start, start + _AGAINST), self.sizes[start : start + _AGAINST]
            self._tiles[start] = np.concatenate([y, np.ones((len(y), 1)), m[:, None]], axis=1, dtype="f4")
        return self._tiles[start]

    def common(self, rows: np.ndarray, other: _BitSets, others: np.ndarray) -> np.ndarray:
        """How many elements each of some sets shares with one of another block."""
        return np.bitwise_count(self.bits[rows] & other.bits[others]).sum(axis=1, dtype="i8")


def _best_in_blocks(k: int):
    """Cogroup of two blocks of sets over few elements: the k most similar of the second for each of
    the first, none below its ``least``."""

    def compare(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        out: list[np.ndarray] = []
        if len(mine) and len(theirs):
            left, right = _BitSets(mine), _BitSets(theirs)
            for start in range(0, len(left.ids), _STRIP):
                out.append(_best_of_strip(left, slice(start, start + _STRIP), right, k))
        found = np.concatenate([np.zeros((5, 0), "i8"), *out], axis=1)
        return pa.table({c: pa.array(found[i]) for i, c in enumerate(("id", "other", "common", "n", "m"))})

    return compare


def _best_of_strip(left: _BitSets, strip: slice, right: _BitSets, k: int) -> np.ndarray:
    ids, sizes, least = left.ids[strip], left.sizes[strip].astype("i8"), left.least[strip].copy()
    x = left.as_matrix(strip.start, strip.stop)
    # Sizes within reach, with slack for the rounding of the quotients.
    worst = least.min()
    first = int(np.searchsorted(right.sizes, np.ceil(sizes.min() * worst - 1e-6)))
    last = len(right.ids) if worst == 0 else int(np.searchsorted(right.sizes, sizes.max() / worst + 1e-6, "right"))
    # The nearest sizes first, so that the bounds rise early.
    middle = np.searchsorted(right.sizes, sizes[len(sizes) // 2])
    parts = sorted(range(first // _AGAINST * _AGAINST, last, _AGAINST), key=lambda at: abs(at + _AGAINST // 2 - middle))
    best = np.zeros((5, 0), "i8")
    for at in parts:
        under, other, m = right.tile(at), right.ids[at : at + _AGAINST], right.sizes[at : at + _AGAINST].astype("i8")
        if (least > 0).all():
            # jaccard >= t is common >= t / (1 + t) (n + m); what is nearly so is looked at exactly.
            share = (least / (1 + least)).astype("f4")
            over = np.concatenate([x, (-share * sizes)[:, None], -share[:, None]], axis=1, dtype="f4")
            near = over @ under.T >= -2e-3
        else:
            common = x @ under[:, :-2].T
            jaccard = common / (sizes[:, None] + m[None, :] - common)
            jaccard[ids[:, None] == other[None, :]] = 0
            n = min(k, jaccard.shape[1])
            near = (jaccard >= np.partition(jaccard, -n, axis=1)[:, [-n]]) & (common > 0)
        u, v = np.divmod(np.flatnonzero(near), len(other))
        both = left.common(u + strip.start, right, v + at)
        keep = (ids[u] != other[v]) & (both > 0) & (both / (sizes[u] + m[v] - both) >= least[u])
        u, v, both = u[keep], v[keep], both[keep]
        best = np.concatenate([best, np.stack([u, other[v], both, sizes[u], m[v]])], axis=1)
        u, value = best[0], best[2] / (best[3] + best[4] - best[2])
        order = np.lexsort((best[1], -value, u))
        u, value = u[order], value[order]
        nth = np.arange(len(u)) - np.searchsorted(u, u)
        best = best[:, order[nth < k]]
        full = nth == k - 1
        least[u[full]] = np.maximum(least[u[full]], value[full])
    return np.stack([ids[best[0]], *best[1:]])


def _meet_blocks(blocks: DataFrame, searching: DataFrame, meetings: DataFrame, k: int) -> DataFrame:
    """What the blocks of ``(a, b)`` find in each other; ``searching`` have a bound ``least``."""
    tasks = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asking = searching.selectExpr("block AS a", *renewed("id", "bits", "n", "least"))
    left = meetings.join(asking, "a").repartition(tasks, "a", "b")
    right = meetings.selectExpr(*renewed("a", "b")).join(blocks.selectExpr("block AS b", *renewed("id", "bits", "n")), "b").repartition(tasks, "a", "b")
    return left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInArrow(_best_in_blocks(k), _FOUND)


def _as_bits(width: int):
    """Lists of elements as bits of one length."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = _Sets(pa.Table.from_batches([batch]))
            bits = np.zeros((len(sets.ids), width), "u1")
            bits[np.repeat(np.arange(len(sets.ids)), sets.sizes), sets.elements] = 1
            packed = [row.tobytes() for row in np.packbits(bits, axis=1)]
            columns = {"bits": pa.array(packed, pa.binary())}
            columns |= {c: batch.column(c) for c in ("id", "n", "members")}
            yield pa.RecordBatch.from_pydict(columns)

    return pack


def _by_blocks(sets: DataFrame, k: int, block_sets: int, elements: int) -> DataFrame:
    """The k most similar sets of every set of fewer members, from blocks compared whole."""
    rows = sets.select("id", "set", F.col("n").cast("int").alias("n"), F.size("ids").alias("members"))
    packed = rows.mapInArrow(_as_bits(elements), "bits binary, id bigint, n int, members int")
    count = sets.count()
    size = min(block_sets, max(LEAST_BLOCK, -(-count // SIDE)))
    numbered = ordered_index(packed, ["n", "id"], "at")
    blocks = cut(numbered.selectExpr("id", "bits", "n", "members", f"CAST(at div {size} AS INT) AS block"), "blocks")
    spans = cut(blocks.groupBy("block").agg(F.min("n").alias("lo"), F.max("n").alias("hi")), "spans")
    searching = blocks.where(F.col("members") < k).drop("members")
    own = spans.select(F.col("block").alias("a"), F.col("block").alias("b"))
    first = cut(_meet_blocks(blocks, searching.withColumn("least", F.lit(0.0)), own, k), "found")

    # What the worst set of a block knows as its k-th best bounds the sizes it may look for.
    kth = first.groupBy("id").agg(F.count(F.lit(1)).alias("known"), F.min(F.col("common") / (F.col("n") + F.col("m") - F.col("common"))).alias("least"))
    least = F.when(F.col("known") >= k, F.col("least")).otherwise(0.0).alias("least")
    searching = cut(searching.join(kth, "id", "left").select("block", "id", "bits", "n", least), "searching")
    asked = searching.groupBy("block").agg(F.min("least").alias("least"), F.min("n").alias("n_lo"), F.max("n").alias("n_hi"))
    # One row per block, so a pair of blocks is a row of a small table.
    asked = [tuple(r) for r in asked.collect()]
    met = [
        (a, r["block"])
        for a, t, lo, hi in asked
        for r in spans.collect()
        if a != r["block"] and r["hi"] >= lo * t - 1e-6 and r["lo"] * t <= hi + 1e-6
    ]
    meetings = cut(sets.sparkSession.createDataFrame(met, "a int, b int"), "meetings")
    return first.unionByName(_meet_blocks(blocks, searching, meetings, k))


_STRIDE = 40_503


def _group_of(element, groups: int, long_from: int):
    """The group of an element's list: long lists alone, short ones dealt out."""
    return np.where(element >= long_from, groups + element, element * _STRIDE % groups)


def _best_first(found: DataFrame, k: int, *keys: str) -> DataFrame:
    """The k most similar rows per key; long ones are cut in parts before they are cut whole."""
    order = [F.desc(F.col("common") / (F.col("n") + F.col("m") - F.col("common"))), "other"]
    salt = F.pmod(F.xxhash64("other"), F.lit(SALTS))
    parts = Window.partitionBy(*keys, "_salt").orderBy(*order)
    some = found.withColumn("_salt", salt).withColumn("_nth", F.row_number().over(parts)).where(F.col("_nth") <= k)
    whole = Window.partitionBy(*keys).orderBy(*order)
    some = some.drop("_salt").withColumn("_nth", F.row_number().over(whole))
    return some.where(F.col("_nth") <= k).withColumnRenamed("_nth", "rank")


def _distinct_sets(members: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """``(id, set, n, ids)``, ids the k + 1 lowest members; and ``(member, id)`` of all."""
    salt = F.pmod(F.xxhash64("member"), F.lit(SALTS))
    own = members.groupBy("member").agg(F.sort_array(F.collect_list("rank")).alias("set"))
    own = cut(own, "sets")
    nth = F.row_number().over(Window.partitionBy("set", "_salt").orderBy("member"))
    lowest = own.withColumn("_salt", salt).withColumn("_nth", nth).where(F.col("_nth") <= k + 1)
    nth = F.row_number().over(Window.partitionBy("set").orderBy("member"))
    lowest = lowest.withColumn("_nth", nth).where(F.col("_nth") <= k + 1)
    kept = lowest.groupBy("set").agg(F.sort_array(F.collect_list("member")).alias("ids"))
    kept = cut(kept.select(F.get("ids", F.lit(0)).alias("id"), "set", F.size("set").alias("n"), "ids"), "distinct")
    return kept, own.join(kept.select("set", "id"), "set").select("member", "id")


def _round(sets: DataFrame, probes: DataFrame, lengths: DataFrame, groups: int, long_from: int, k: int) -> DataFrame:
    """Pairs found in the lists of the probing sets' elements at positions ``lo`` to ``hi``."""
    def grouped(df: DataFrame, places: str) -> DataFrame:
        group = f"if(e >= {long_from}, {groups}L + e, e * {_STRIDE}L % {groups}L)"
        return df.withColumn("grp", F.explode(F.expr(f"array_distinct(transform({places}, e -> {group}))")))

    # Long lists are cut; of all others there is one block.
    blocks = F.coalesce("blocks", F.lit(1))

    def dealt(df: DataFrame, mine: str, other: str) -> DataFrame:
        at = F.pmod(F.xxhash64("id"), blocks).cast("int").alias(mine)
        every = F.explode(F.sequence(F.lit(0), blocks - 1)).alias(other)
        return df.join(lengths, "grp", "left").select(at, every, *df.columns)

    asking = probes.where("hi > lo").withColumns({"groups": F.lit(groups), "long_from": F.lit(long_from)})
    left = dealt(grouped(asking, "slice(set, lo + 1, hi - lo)"), "a", "b")
    right = dealt(grouped(sets.selectExpr(*renewed("id", "set")), "set"), "b", "a")
    keys = ["grp", "a", "b"]
    # By number: what travels is little for the work it makes, and adaptive execution, which goes
    # by size, would leave it to few tasks.
    tasks = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left, right = left.repartition(tasks, *keys), right.repartition(tasks, *keys)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_best_in_lists(k), _FOUND)


def _expanded(sets: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """The k + 1 best members for each set, its own among them."""
    # Every set has a member, its id, that comes before all of a later set's.
    found = _best_first(found, k + 1, "id").drop("rank")
    own = sets.select("id", F.explode("ids").alias("other"), *[F.col("n").cast("long").alias(c) for c in ("common", "n", "m")])
    members = sets.select(F.col("id").alias("_other"), "ids")
    theirs = found.withColumnRenamed("other", "_other").join(members, "_other")
    theirs = theirs.select("id", F.explode("ids").alias("other"), "common", "n", "m")
    return _best_first(own.unionByName(theirs), k + 1, "id")


def _by_lists(sets: DataFrame, ranked: DataFrame, k: int, first: int, list_rows: int, group_rows: int) -> DataFrame:
    """What every set finds in the lists of its elements, enough for its k best members."""
    short = ranked.agg(F.count(F.when(F.col("f") <= list_rows, 1)), F.sum(F.when(F.col("f") <= list_rows, F.col("f")))).first()
    long_from, groups = short[0], max(1, (short[1] or 0) // group_rows)
    lengths = ranked.where(F.col("rank") >= long_from)
    lengths = lengths.select((F.col("rank") + groups).alias("grp"), F.ceil(F.col("f") / list_rows).cast("int").alias("blocks"))
    lengths = cut(lengths, "lengths")

    least = F.least(F.col("n"), F.lit(first))
    nothing = {"best": F.lit(0).cast("long"), "of": F.lit(1).cast("long")}
    start = sets.select("id", "set", F.lit(0).alias("lo"), least.alias("hi")).withColumns(nothing)
    found = cut(_round(sets, start, lengths, groups, long_from, k + 1), "found")
    # The k + 1 best that a set knows, its own members included, bound what is worth looking for.
    bound = _expanded(sets, found, k).where(F.col("rank") == k + 1)
    bound = bound.select("id", F.col("common").alias("best"), (F.col("n") + F.col("m") - F.col("common")).alias("of"))
    known = sets.join(bound, "id", "left").withColumns({"best": F.coalesce("best", F.lit(0)), "of": F.coalesce("of", F.lit(1))})
    # Positions p with (n - p) / n not below the bound.
    last = F.floor((F.col("n") * (F.col("of") - F.col("best"))) / F.col("of")).cast("int") + 1
    onward = known.select("id", "set", least.alias("lo"), F.least(F.col("n"), last).alias("hi"), "best", "of")
    return found.unionByName(cut(_round(sets, onward, lengths, groups, long_from, k + 1), "found"))


def similar_sets(
    elements: DataFrame,
    k: int,
    first: int = FIRST,
    list_rows: int = LIST,
    large: int = LARGE,
    group_rows: int = GROUP,
    few_elements: int = FEW_ELEMENTS,
    block_sets: int = BLOCK_SETS,
) -> DataFrame:
    """``(member, rank, other, common, n, m)``: the k sets with the largest Jaccard index to each.

    ``elements`` is ``(member, element)``. Only sets that share an element count; ties go to the
    lowest member. ``n`` and ``m`` are the sizes of the two sets.
    """
    rows = cut(elements.where("member IS NOT NULL AND element IS NOT NULL").distinct(), "elements")
    counted = rows.groupBy("element").agg(F.count(F.lit(1)).alias("f"))
    ranked = cut(ordered_index(counted, ["f", "element"], "rank"), "ranks")
    sizes = cut(rows.groupBy("member").agg(F.count(F.lit(1)).alias("n")), "sizes")
    named = rows.join(ranked.select("element", "rank"), "element").select("member", F.col("rank").cast("int").alias("rank"))
    named = cut(named, "named")

    few = sizes.where(F.col("n") <= large).select("member")
    sets, of_member = _distinct_sets(named.join(few, "member", "left_semi"), k)
    # Pairs met in lists, against all pairs.
    met, different = ranked.agg(F.sum(F.col("f").cast("double") ** 2), F.count(F.lit(1))).first()
    if different <= few_elements and (met or 0) > 2 * sizes.count() ** 2:
        found = cut(_by_blocks(sets, k + 1, block_sets, different), "found")
    else:
        found = _by_lists(sets, ranked, k, first, list_rows, group_rows)
    near = cut(_expanded(sets, found, k), "near")

    # Every member of a set takes from its list what is not itself.
    listed = near.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("rank", "other", "common", "n", "m"))).alias("list"))
    others = F.slice(F.filter("list", lambda x: x["other"] != F.col("member")), 1, k)
    lists = of_member.join(cut(listed, "lists"), "id").select("member", others.alias("list"))
    columns = ["list.other", "list.common", "list.n", "list.m"]

    # Large sets meet all others by their elements.
    many = sizes.where(F.col("n") > large)
    if many.isEmpty():
        ranks = lists.select("member", F.posexplode("list").alias("at", "list"))
        return ranks.select("member", (F.col("at") + 1).alias("rank"), *columns)
    pairs = lists.select("member", F.explode("list").alias("list")).select("member", *columns)
    big = cut(named.join(many.select("member"), "member", "left_semi"), "large")
    met = big.join(named.withColumnRenamed("member", "other"), "rank").where("member <> other")
    met = met.groupBy("member", "other").agg(F.count(F.lit(1)).alias("common"))
    met = cut(met, "overlaps")
    met = met.unionByName(
        met.join(many, F.col("other") == many["member"], "left_anti").select(
            F.col("other").alias("member"), F.col("member").alias("other"), "common"
        )
    )
    met = met.join(sizes, "member").join(sizes.select(F.col("member").alias("other"), F.col("n").alias("m")), "other")
    pairs = pairs.unionByName(met.select(pairs.columns))
    return _best_first(pairs, k, "member").select("member", "rank", "other", "common", "n", "m")

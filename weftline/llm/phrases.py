"""Phrases of two and three words that stick together, mined shard by shard (SON).

Documents are dealt into ``SHARDS`` shards by a hash. A shard that holds a share of all words is
mined completely at that share of the support, rounded up: if a phrase of a language were below
the local support in every shard, its counts would add up to less than the support, so every
phrase with the support is locally frequent somewhere. The shards' locally frequent phrases
are united, and a last pass over all texts counts the united candidates, and only those, exactly.

Within a shard, mining goes by length: only phrases whose two shorter parts are locally frequent
are counted, which a filter of fixed size sent to all tasks decides (it may pass more, never
fewer). A shard is a label of rows, not a task: any number of tasks reads its rows and adds up
what it found in a buffer before one exchange, so no task holds a shard, a language or a phrase's
occurrences. More shards make lower local supports and more candidates; a support of s allows
s - 1 shards at most before everything is a candidate.

The mining passes know phrases by 64-bit hashes (words are found and hashed on the Arrow
buffers). Equal phrases have equal hashes, so a collision can only add a candidate; the last
pass counts the phrases themselves, so its counts are exact.

Of the candidates, those inside a longer one that has half their count are dropped, each is
scored at its weakest cut, and each language's best are numbered.

Defined results: null texts are empty; a null language is ``und``; pieces end at ``.,;:!?`` and
at line breaks, words at blanks and tabs; A-Z are lower-cased; an empty table gives an empty
table; repeated rows count each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.membership import KeyFilter, key_filter
from weftline.llm.word_hashes import NOT_BLANK, Block, blocks, mix, words
from weftline.shared import Tables

LONGEST = 3
SUPPORT = 10
COVERED_PERCENT = 50
SHARDS = 3
TOP = 2_000

# Rows gathered by a task before they are added up, and groups a language's ranking starts in.
GATHERED = 1 << 20
RANK_GROUPS = 32

_WORD_MEMBERS = NOT_BLANK.member.copy()
_BREAKS = np.zeros(256, bool)
for _byte in b".,;:!?\n\x0b\x0c\r":
    _WORD_MEMBERS[_byte], _BREAKS[_byte] = False, True
PHRASE_WORDS = NOT_BLANK._replace(member=_WORD_MEMBERS)


class Grams(NamedTuple):
    """The runs of k words within pieces: keys (language and words), rows, first words."""

    keys: np.ndarray
    rows: np.ndarray
    firsts: np.ndarray


class Pieces:
    """The words of a block, and which of them lie in one piece of a row."""

    def __init__(self, block: Block, languages: np.ndarray) -> None:
        self.block, self.languages = block, languages
        self.words = words(block, PHRASE_WORDS)
        self.rows = self.words.rows
        breaks = np.cumsum(_BREAKS[block.data], dtype="i8")
        # A break lies between words, so its running count at a word's first byte is its piece.
        self.pieces = breaks[self.words.starts] if len(self.words.starts) else np.zeros(0, "i8")

    def grams(self, k: int) -> Grams:
        n = len(self.rows) - k + 1
        if n <= 0:
            none = np.zeros(0, "i8")
            return Grams(none.view("u8"), none, none)
        inside = (self.rows[:n] == self.rows[k - 1 :]) & (self.pieces[:n] == self.pieces[k - 1 :])
        firsts = np.flatnonzero(inside)
        keys = np.full(len(firsts), k, "u8")
        for j in range(k):
            keys = mix(keys) + self.words.hashes[firsts + j]
        rows = self.rows[firsts]
        return Grams(mix(mix(keys) + self.languages[rows]), rows, firsts)


def _passing(found: Grams, shorter: Grams, allowed: KeyFilter) -> np.ndarray:
    """Which grams have both parts of one word less among those allowed."""
    ok = np.zeros(int(shorter.firsts[-1]) + 1 if len(shorter.firsts) else 0, bool)
    ok[shorter.firsts[allowed.passes(shorter.keys)]] = True
    # Both parts of a gram lie in its piece, so they are among the shorter ones.
    return ok[found.firsts] & ok[found.firsts + 1]


_MINED = "shard int, key bigint, n bigint"


def _added_up(shards: list[np.ndarray], keys: list[np.ndarray]) -> pa.RecordBatch:
    shard, key = np.concatenate(shards), np.concatenate(keys)
    order = np.lexsort((key, shard))
    shard, key = shard[order], key[order]
    first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (shard[1:] != shard[:-1])][: len(key)])
    n = np.diff(np.r_[first, len(key)]).astype("i8")
    columns = [pa.array(shard[first]), pa.array(key[first].view("i8")), pa.array(n)]
    return pa.RecordBatch.from_arrays(columns, names=["shard", "key", "n"])


def _mine(k: int, sent):
    """Count the grams of each shard; with a filter, those whose parts pass it."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, keys, held = [], [], 0
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            salt = batch.column("salt").to_numpy().view("u8")
            for block in blocks(batch.column("text")):
                of = slice(block.first, block.first + block.rows)
                pieces = Pieces(block, salt[of])
                found = pieces.grams(k)
                if sent is not None:
                    kept = _passing(found, pieces.grams(k - 1), sent.value)
                    found = Grams(*(x[kept] for x in found))
                shards.append(shard[of][found.rows])
                keys.append(found.keys)
                held += len(found.keys)
                if held >= GATHERED:
                    yield _added_up(shards, keys)
                    shards, keys, held = [], [], 0
        if held:
            yield _added_up(shards, keys)

    return scan


def _spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Strings of ``(n, k)`` runs of bytes, each row's joined by blanks."""
    n, k = starts.shape
    # The blank to join with is one byte behind the data.
    data = np.append(data, np.uint8(32))
    begin, size = np.full((n, 2 * k - 1), len(data) - 1), np.ones((n, 2 * k - 1), "i8")
    begin[:, ::2], size[:, ::2] = starts, ends - starts
    flat, lengths = begin.ravel(), size.ravel()
    outer = np.cumsum(lengths)
    index = np.arange(outer[-1] if len(outer) else 0) + np.repeat(flat - outer + lengths, lengths)
    offsets = np.concatenate([[0], outer[2 * k - 2 :: 2 * k - 1]]).astype("i4")
    return pa.Array.from_buffers(
        pa.string(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[index].tobytes())]
    )


_COUNTED = "lang string, k int, phrase string, n bigint"


def _count(sent, longest: int):
    """Count the candidates among all grams, as words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted: KeyFilter = sent.value
        for batch in batches:
            lang = batch.column("lang")
            salt = batch.column("salt").to_numpy().view("u8")
            for block in blocks(batch.column("text"), 4 << 20):
                pieces = Pieces(block, salt[block.first : block.first + block.rows])
                folded = PHRASE_WORDS.fold[block.data]
                # All words of a language, as a phrase of none.
                rows, n = np.unique(pieces.rows, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        lang.take(pa.array(rows + block.first)),
                        pa.array(np.zeros(len(n), "i4")),
                        pa.array([""] * len(n), pa.string()),
                        pa.array(n.astype("i8")),
                    ],
                    names=["lang", "k", "phrase", "n"],
                )
                for k in range(1, longest + 1):
                    found = pieces.grams(k)
                    kept = wanted.passes(found.keys)
                    _, first, n = np.unique(found.keys[kept], return_index=True, return_counts=True)
                    if not len(n):
                        continue
                    at = found.firsts[kept][first][:, None] + np.arange(k)
                    yield pa.RecordBatch.from_arrays(
                        [
                            lang.take(pa.array(found.rows[kept][first] + block.first)),
                            pa.array(np.full(len(n), k, "i4")),
                            _spans(folded, pieces.words.starts[at], pieces.words.ends[at]),
                            pa.array(n.astype("i8")),
                        ],
                        names=["lang", "k", "phrase", "n"],
                    )

    return scan


class Counts(NamedTuple):
    """``(lang, n)`` of all words, and ``(lang, k, phrase, f)`` with the support; one written table."""

    words: DataFrame
    phrases: DataFrame


def frequent_phrases(
    docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, shards: int = SHARDS
) -> Counts:
    """All runs of up to ``longest`` words with the support in their language, counted exactly."""
    spark, tables = docs.sparkSession, Tables(docs.sparkSession)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int")
    texts = docs.select("text", lang.alias("lang"), F.xxhash64(lang).alias("salt"), shard.alias("shard"))

    def mine(k: int, allowed: KeyFilter | None) -> DataFrame:
        sent = None if allowed is None else spark.sparkContext.broadcast(allowed)
        found = texts.mapInArrow(_mine(k, sent), _MINED)
        return found.groupBy("shard", "key").agg(F.sum("n").alias("n"))

    def locally_frequent(found: DataFrame) -> DataFrame:
        return found.join(F.broadcast(supports), "shard").where("n >= least").select("key").distinct()

    one = tables.cut(mine(1, None), "words")
    sizes = one.groupBy("shard").agg(F.sum("n").alias("n"))
    # One row per shard. Any shares that add up to one will do for the support's bound.
    total = F.sum("n").over(Window.partitionBy())
    supports = tables.cut(sizes.withColumn("total", total).selectExpr("shard", f"({support} * n + total - 1) div total AS least"))
    known = tables.cut(locally_frequent(one), "mined")
    union = known
    for k in range(2, longest + 1):
        known = tables.cut(locally_frequent(mine(k, key_filter(known, "key"))), "mined")
        union = union.unionByName(known)
    wanted = spark.sparkContext.broadcast(key_filter(union, "key"))
    counted = texts.mapInArrow(_count(wanted, longest), _COUNTED)
    counted = counted.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("f"))
    counted = tables.cut(counted.where((F.col("f") >= support) | (F.col("k") == 0)), "counted")
    totals = counted.where("k = 0").select("lang", F.col("f").alias("n"))
    return Counts(totals, counted.where("k > 0"))


def _exact(value: Column) -> Column:
    return value.cast("decimal(15,0)")


def collocations(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, shards: int = SHARDS) -> DataFrame:
    """``(lang, phrase, k, a, l, r, n, score)``: all phrases left, scored at their weakest cut."""
    counts = frequent_phrases(docs, support, longest, shards)
    tables = Tables(docs.sparkSession)
    known = counts.phrases.select("lang", F.col("phrase").alias("part"), "f")
    found = counts.phrases.where("k >= 2").withColumn("w", F.split("phrase", " "))

    def run(first: str | Column, size: str | Column) -> Column:
        return F.array_join(F.slice("w", first, size), " ")

    # Longer ones that hold it, by every shorter run of their words.
    longer = found.where("k >= 3").select("lang", "f", "k", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("m"), "w")
    starts = F.sequence(F.lit(1), F.col("k") - F.col("m") + 1)
    longer = longer.select("lang", "f", F.explode(F.transform(starts, lambda i: run(i, F.col("m")))).alias("phrase"))
    held = tables.cut(longer.groupBy("lang", "phrase").agg(F.max("f").alias("most")), "longer")
    kept = found.join(held, ["lang", "phrase"], "left")
    kept = kept.where(f"most IS NULL OR 100 * most < {COVERED_PERCENT} * f").drop("most")

    # A frequent word is part of very many phrases; both sides are plain tables, so that adaptive
    # execution can split its partition.
    cuts = F.sequence(F.lit(1), F.col("k") - 1)
    asked = kept.select("lang", "phrase", "k", F.col("f").alias("a"), "w", F.explode(cuts).alias("cut"))
    sides = asked.select(
        "lang", "phrase", "k", "a", "cut", run(F.lit(1), F.col("cut")).alias("left"), run(F.col("cut") + 1, F.col("k")).alias("right")
    )
    for side in ("left", "right"):
        part = known.withColumnsRenamed({"part": side, "f": side[0]})
        sides = tables.cut(sides, "cuts").join(part, ["lang", side])
    million = F.lit(1_000_000).cast("decimal(7,0)")
    a, parts = _exact(F.col("a")), _exact(F.col("l")) * _exact(F.col("r"))
    scored = sides.withColumns({"_top": a * a * million, "_parts": parts}).withColumn("score", F.expr("_top div _parts"))
    weakest = F.min(F.struct("score", "cut", "l", "r")).alias("c")
    scored = scored.groupBy("lang", "phrase", "k", "a").agg(weakest)
    # One row per language, so this side is small.
    named = scored.join(F.broadcast(counts.words), "lang")
    return named.select("lang", "phrase", "k", "a", "c.l", "c.r", "n", "c.score")


def best_collocations(docs: DataFrame, top: int = TOP, **mining: int) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's best, numbered from 1.

    Groups of a language are cut to ``top`` before the language is, so no task ranks it whole.
    """
    scored = collocations(docs, **mining).withColumn("_group", F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS)))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    first = F.row_number().over(Window.partitionBy("lang", "_group").orderBy(*order))
    some = scored.withColumn("_rank", first).where(F.col("_rank") <= top).drop("_rank", "_group")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ranked = some.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

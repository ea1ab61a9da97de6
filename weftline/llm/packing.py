"""Packing of tokenised documents into sequences of fixed length, best fit decreasing.

Best fit decreasing handles documents from the longest to the shortest and puts each into the
open sequence it fills tightest. Pieces of equal length are interchangeable, and so are open
sequences with equal room. The exact outcome for all pieces of the corpus therefore follows
from how many pieces there are of each length, at most ``capacity`` numbers: the plan places
runs of pieces at once, finding the tightest room with a segment tree over the rooms left. Its
steps depend on the lengths that occur, not on the number of documents.

What is done per piece is distributed: tokenising (which writes the pieces, each numbered among
its task's pieces of its length), adding the counts of earlier tasks, and looking up its step.

Tokens are those of the given tokenizer, then one end token per document. Where its pre-tokens
never hold white space, a text's tokens are those of its parts between white space. The parts of
many texts are split off and told apart as Arrow columns, so that Python handles each different
part of a block once; known parts are taken from a bounded table kept by each worker.

Defined results: null and empty texts are the end token alone; only documents longer than the
capacity are cut, into full pieces and a rest; repeated rows and ties are packed each; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import json
from array import array
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weftline.llm.word_hashes import blocks
from weftline.shared import Tables

CAPACITY = 4096
END_ID = 1
TEXT_BYTES_AT_ONCE = 6 << 20
KNOWN_PARTS = 400_000
# Rows of the numbers of earlier tasks up to which they may be sent to all tasks.
BROADCAST_ROWS = 500_000

# Separators that are white space to Arrow and not to the tokenizer.
_ODD = "[\x1c-\x1f]"
# Letters below this have one-letter lower case and no combining marks.
_PLAIN = "İ"

# The steps of a tokenizer whose text parts can be encoded one by one.
_BY_PARTS = [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]]


def _steps(stage: dict | None, inner: str) -> list[str]:
    if stage is None:
        return []
    return [x["type"] for x in stage.get(inner, [stage])]


def _byte_letters() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself if printable."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Encoder:
    """Token ids of texts, by parts between white space.

    Splitting at white space is right for tokenizers that drop it, lower-case, and part letters
    from the rest (the kinds named in ``_BY_PARTS``); with any other, texts are encoded whole.
    """

    def __init__(self, definition: str) -> None:
        self.tokenizer = Tokenizer.from_str(definition)
        parsed = json.loads(definition)
        steps = [_steps(parsed["normalizer"], "normalizers"), _steps(parsed["pre_tokenizer"], "pretokenizers")]
        self.by_parts = steps == _BY_PARTS and parsed["model"]["type"] == "BPE"
        self.letters = dict(enumerate(_byte_letters()))
        # Two generations of known parts: a full one becomes the older, which is then replaced.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        """A word of plain letters is one pre-token, which the model takes as it is."""
        shown = word.lower()
        if not shown.isascii():
            shown = shown.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(shown)]).tobytes()

    def _learn(self, parts: set[str]) -> None:
        known, older = self.known, self.older
        for part in parts:
            stem = part.rstrip(".,")
            if not stem.isalpha():
                known[part] = self._encode(part)
                continue
            ids = known.get(stem) or older.get(stem)
            if ids is None:
                if not stem.isascii() and max(stem) >= _PLAIN:
                    known[part] = self._encode(part)
                    continue
                ids = self._word(stem)
            known[stem] = ids
            if tail := part[len(stem) :]:
                if tail not in known:
                    known[tail] = self._encode(tail)
                known[part] = ids + known[tail]

    def _parts(self, parts: list[str]) -> list[bytes]:
        """Ids of different parts."""
        if len(self.known) > KNOWN_PARTS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = {p for p in parts if p not in known}
        if new:
            known.update((p, older[p]) for p in new if p in older)
            self._learn({p for p in new if p not in known})
        return [known[p] for p in parts]

    def encode(self, texts: pa.Array, end_id: int) -> Tokens:
        """The ids of all texts, each with the end token behind it."""
        whole = pc.fill_null(texts, "")
        apart = pc.match_substring_regex(whole, _ODD) if self.by_parts else pa.array([True] * len(texts), pa.bool_())
        odd = np.flatnonzero(apart.to_numpy(zero_copy_only=False))
        split = pc.utf8_split_whitespace(pc.if_else(apart, "", whole))
        parts = split.flatten().dictionary_encode()
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        ids = self._parts(parts.dictionary.to_pylist()) if self.by_parts else [b""] * len(parts.dictionary)
        # Behind the parts come the texts that are encoded whole and the end token.
        known = len(ids)
        ids += [self._encode(whole[i].as_py()) for i in odd.tolist()]
        ids.append(int(end_id).to_bytes(4, "little"))
        which = parts.indices.to_numpy().astype("i8")
        at = np.concatenate([bounds[1:][odd], bounds[1:]])
        more = np.concatenate([np.arange(known, known + len(odd)), np.full(len(texts), known + len(odd))])
        which = np.insert(which, at, more)
        sizes = np.array([len(x) // 4 for x in ids], "i8")
        flat = np.frombuffer(b"".join(ids), "<u4")
        starts, n = (np.cumsum(sizes) - sizes)[which], sizes[which]
        so_far = np.cumsum(n)
        taken = flat[np.arange(so_far[-1] if len(n) else 0) + np.repeat(starts - so_far + n, n)]
        # Every text has one more than its parts, an odd one two.
        extra = np.ones(len(texts), "i8")
        extra[odd] += 1
        last = bounds[1:] + np.cumsum(extra) - 1
        return Tokens(taken, np.concatenate([[0], so_far[last]]))


class Tokens(NamedTuple):
    """Ids of some texts, and where each text's begin and end."""

    ids: np.ndarray
    bounds: np.ndarray


_encoders: dict[int, Encoder] = {}


def encoder(definition: str) -> Encoder:
    """One per worker process."""
    key = hash(definition)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(definition)
    return _encoders[key]


_PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"


def _pieces(definition, capacity: int, end_id: int, with_ids: bool):
    """Tokenise; number each piece among its task's pieces of its length."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(definition.value).encode
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, "i8")
        for batch in batches:
            for block in blocks(batch.column("text"), TEXT_BYTES_AT_ONCE):
                few = batch.slice(block.first, block.rows)
                tokens = encode(few.column("text"), end_id)
                size = np.diff(tokens.bounds)
                pieces = -(-size // capacity)
                owner = np.repeat(np.arange(len(size)), pieces)
                k = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = k * capacity
                length = np.minimum(size[owner] - start, capacity)
                first = tokens.bounds[:-1][owner] + start
                raw = memoryview(tokens.ids.tobytes())
                sums = [crc32(raw[4 * a : 4 * b]) for a, b in zip(first.tolist(), (first + length).tolist(), strict=True)]
                # Places among the pieces of equal length, in the order they come.
                order = np.argsort(length, kind="stable")
                nth = np.empty(len(length), "i8")
                nth[order] = np.arange(len(length)) - np.searchsorted(length[order], length[order])
                nth += seen[length]
                seen += np.bincount(length, minlength=capacity + 1)
                columns = [
                    few.column("doc_id").take(pa.array(owner)),
                    pa.array(k.astype("i4")),
                    pa.array(start),
                    pa.array(length),
                    pa.array(sums, pa.int64()),
                    pa.array(np.full(len(owner), part, "i4")),
                    pa.array(nth),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
                if with_ids:
                    # Pieces lie one behind the other.
                    ends = (np.concatenate([[0], np.cumsum(length)]) * 4).astype("i4")
                    ids = pa.Array.from_buffers(pa.binary(), len(owner), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw)])
                    columns, names = [*columns, ids], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return scan


class RoomTree:
    """Which rooms (tokens left in open sequences) exist, as a segment tree."""

    def __init__(self, largest: int) -> None:
        self.leaves = 1 << largest.bit_length()
        self.any = bytearray(2 * self.leaves)

    def set(self, room: int, present: bool) -> None:
        i = self.leaves + room
        self.any[i] = present
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] | self.any[2 * i + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest room of at least ``least``."""
        i = self.leaves + least
        if self.any[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.leaves
            i //= 2
        return None


class Step(NamedTuple):
    """Pieces ``nth .. nth + pieces - 1`` of a length, ``each`` to a sequence, from an offset on."""

    length: int
    nth: int
    pieces: int
    each: int
    sequence: int
    offset: int


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[Step]:
    """The steps of best fit decreasing for so many pieces of each length."""
    rooms: dict[int, deque[tuple[int, int]]] = {}
    tree = RoomTree(capacity)
    steps: list[Step] = []
    sequences = 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            rooms.setdefault(room, deque()).append((first, n))
            tree.set(room, True)

    for length in sorted(counts, reverse=True):
        nth, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                # No other sequence can take this length, so new ones are filled one by one.
                each, room = capacity // length, capacity
                first, n = sequences, -(-left // each)
                sequences += n
            else:
                # A sequence that takes one and has room for another is again the tightest.
                each = room // length
                first, n = rooms[room].popleft()
                use = min(n, -(-left // each))
                if use < n:
                    rooms[room].appendleft((first + use, n - use))
                elif not rooms[room]:
                    tree.set(room, False)
                n = use
            placed = min(left, n * each)
            steps.append(Step(length, nth, placed, each, first, capacity - room))
            full, rest = divmod(placed, each)
            put(room - each * length, first, full)
            put(room - rest * length, first + full, 1 if rest else 0)
            nth, left = nth + placed, left - placed
    return steps


def _places(plan):
    """Look up a piece's step by its length and number, and place it."""

    @F.arrow_udf("struct<sequence_id bigint, offset bigint>")
    def places(lengths: pa.Array, numbers: pa.Array) -> pa.Array:
        steps = plan.value
        length, nth = lengths.to_numpy().astype("i8"), numbers.to_numpy().astype("i8")
        starts = (steps["length"] << 48) + steps["nth"]
        step = np.searchsorted(starts, (length << 48) + nth, side="right") - 1
        j, each = nth - steps["nth"][step], steps["each"][step]
        sequence = steps["sequence"][step] + j // each
        offset = steps["offset"][step] + (j % each) * length
        return pa.StructArray.from_arrays(
            [pa.array(sequence), pa.array(offset)], names=["sequence_id", "offset"]
        )

    return places


def pack(
    docs: DataFrame, definition: str, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = False
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``: every piece.

    ``definition`` is the tokenizer's JSON. With ``ids`` each piece's token ids are added, as
    little-endian unsigned 32-bit numbers; they are then written with the pieces.
    """
    spark, tables = docs.sparkSession, Tables(docs.sparkSession)
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    kinds = f"doc_id {doc_type}, {_PIECES}" + (", ids binary" if ids else "")
    sent = spark.sparkContext.broadcast(definition)
    made = docs.select("doc_id", "text").mapInArrow(_pieces(sent, capacity, end_id, ids), kinds)
    pieces = tables.cut(made, "pieces")
    counts = tables.cut(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "counts")
    total = counts.groupBy("length").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts")).collect()
    steps = best_fit_decreasing({r["length"]: r["n"] for r in total}, capacity)
    steps.sort(key=lambda s: (s.length, s.nth))
    plan = {name: np.array([getattr(s, name) for s in steps], "i8") for name in Step._fields}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.select(
        "part", "length", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("_earlier")
    )
    # One row per task and length, which compress so well that their file is no measure of them.
    if sum(r["parts"] for r in total) > BROADCAST_ROWS:
        earlier = earlier.hint("merge")
    places = _places(spark.sparkContext.broadcast(plan))
    numbered = pieces.join(earlier, ["part", "length"])
    placed = numbered.withColumn("_at", places("length", F.col("nth") + F.col("_earlier")))
    columns = ["doc_id", "piece", "start", "length", *(["ids"] if ids else []), "ids_crc32"]
    return placed.select(*columns, "_at.sequence_id", "_at.offset")

"""Words of whole texts as 64-bit hashes, for whole Arrow columns at once.

A text column is one buffer of bytes with offsets. Words are found and hashed on that buffer
with numpy, a few megabytes at a time, without a Python object per word. A word's hash is a
polynomial of its bytes modulo 2^64 (from running sums, so any length costs the same), then
mixed. Equal words have equal hashes; two different words among n differ but for a chance of
about n^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20
_SEGMENT = 1 << 19

_SPLIT = [np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finisher)."""
    x = np.asarray(x, dtype="u8")
    x = (x ^ (x >> np.uint64(30))) * _SPLIT[0]
    x = (x ^ (x >> np.uint64(27))) * _SPLIT[1]
    return x ^ (x >> np.uint64(31))


def mix_int(x: int) -> int:
    return int(mix(np.array([x & (1 << 64) - 1], dtype="u8"))[0])


_STEP = mix_int(11) | 1
_BACK = pow(_STEP, -1, 1 << 64)
_BYTE = mix(np.arange(1, 257, dtype="u8"))
_powers = {"on": np.ones(1, "u8"), "back": np.ones(1, "u8")}


def _power(name: str, n: int) -> np.ndarray:
    """The first n powers, made once and longer only for a longer run of bytes."""
    if len(_powers[name]) < n:
        base = _STEP if name == "on" else _BACK
        steps = np.full(max(n, _SEGMENT + 1), base, dtype="u8")
        steps[0] = 1
        _powers[name] = np.cumprod(steps, dtype="u8")
    return _powers[name][:n]


class Alphabet(NamedTuple):
    """Which bytes belong to words, and what they are folded to."""

    member: np.ndarray
    fold: np.ndarray


def _alphabet(separators: list[range]) -> Alphabet:
    member, fold = np.ones(256, bool), np.arange(256, dtype="u1")
    fold[ord("A") : ord("Z") + 1] += 32
    for r in separators:
        member[r.start : r.stop] = False
    return Alphabet(member, fold)


# Words of anything but white space, and words of ASCII letters, digits and all beyond ASCII;
# both with A-Z lower-cased.
NOT_BLANK = _alphabet([range(0x20, 0x21), range(0x09, 0x0E)])
LETTERS_DIGITS = _alphabet([range(0x00, 0x30), range(0x3A, 0x41), range(0x5B, 0x61), range(0x7B, 0x80)])


class Block(NamedTuple):
    """Some rows of a batch: their bytes, where each row's bytes and words begin and end."""

    first: int
    rows: int
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Hashes, byte bounds, and per row the range of its words."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def blocks(column: pa.Array, target: int = BLOCK_BYTES) -> Iterator[Block]:
    """The rows of a text column in runs of about ``target`` bytes; null texts are empty."""
    column = pc.fill_null(column, "")
    wide = column.type == pa.large_string()
    buffers = column.buffers()
    kind = "i8" if wide else "i4"
    if len(column) == 0:
        return
    offsets = np.frombuffer(buffers[1], kind)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype("i8")
    data = np.frombuffer(buffers[2], "u1") if buffers[2] is not None else np.zeros(0, "u1")
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + target, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        base = offsets[first]
        yield Block(first, last - first, data[base : offsets[last]], offsets[first : last + 1] - base)
        first = last


def word_bounds(block: Block, alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray]:
    inside = alphabet.member[block.data]
    n = len(inside)
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    # A row's first and last bytes bound words whatever the neighbouring row holds.
    begin, end = block.offsets[:-1], block.offsets[1:] - 1
    begin, end = begin[begin < n], end[end >= 0]
    opens[begin] = inside[begin]
    closes[end] = inside[end]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def byte_sums(data: np.ndarray) -> np.ndarray:
    """Running sums of the bytes' polynomial terms, one more than there are bytes."""
    sums = np.zeros(len(data) + 1, "u8")
    np.cumsum(_BYTE[data] * _power("on", len(data)), out=sums[1:], dtype="u8")
    return sums


def hash_spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * _power("back", len(sums))[starts])


def words(block: Block, alphabet: Alphabet) -> Words:
    """The words of a block's rows, by runs of bytes that end at a word's end."""
    starts, ends = word_bounds(block, alphabet)
    hashes = np.empty(len(starts), "u8")
    folded = alphabet.fold[block.data]
    at = 0
    while at < len(starts):
        base = starts[at]
        to = max(int(np.searchsorted(ends, base + _SEGMENT, side="right")), at + 1)
        sums = byte_sums(folded[base : ends[to - 1]])
        hashes[at:to] = hash_spans(sums, starts[at:to] - base, ends[at:to] - base)
        at = to
    bounds = np.searchsorted(starts, block.offsets, side="left")
    return Words(hashes, starts, ends, bounds)


def grams(found: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k words from each word on, and which of them lie within one row."""
    n = len(found.hashes) - k + 1
    if n <= 0:
        return np.zeros(0, "u8"), np.zeros(0, bool)
    out = np.zeros(n, "u8")
    for j in range(k):
        out = out * np.uint64(_STEP) + found.hashes[j : j + n]
    rows = found.rows
    return mix(out), rows[:n] == rows[k - 1 : k - 1 + n]

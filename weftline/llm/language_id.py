"""Language identification with hyperdimensional profiles.

Every letter has a random vector of signs, drawn from its code point. A trigram's vector is the
product of its letters' vectors, rotated by two, one and no places, so that order counts. A
document is the sum of its trigrams' vectors (lower-cased letters; anything else is one blank
between words), a language's prototype the sum of its training documents. A document gets the
language whose prototype is nearest by cosine, less what all prototypes have in common.

A sum of vectors is linear in trigram counts, so a batch of rows is one matrix of counts times
one of trigram vectors. Training adds up counts per language in each task and sends one vector
per task and language; the prototypes, of which there are as many as languages, are all that
reaches the driver. Every training row and every whole text is used.

Defined results: a null text or one without a letter is ``und`` with score 0, as is every row
when nothing was learned; a text whose trigrams cancel out has score 0 and the first language;
rows without doc_id are in the training fold; ties go to the first language in sorted order;
repeated rows score alike; empty tables give empty tables; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.word_hashes import Block, blocks

DIMENSIONS = 1024
UNKNOWN = "und"
# Trigrams of a batch are numbered densely up to this many letters in it.
SMALL_ALPHABET = 200
CELLS = 6_000_000
BLANK = 0


class Letters(NamedTuple):
    lower: np.ndarray
    member: np.ndarray


@lru_cache(maxsize=1)
def letters() -> Letters:
    """Lower case and letterhood of every code point."""
    lower = np.arange(0x110000, dtype="i4")
    member = np.zeros(0x110000, bool)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            member[i] = True
            if len(small := c.lower()) == 1:
                lower[i] = ord(small)
    return Letters(lower, member)


@lru_cache(maxsize=20_000)
def _letter(code: int) -> np.ndarray:
    signs = np.random.Generator(np.random.PCG64([7, code])).integers(0, 2, DIMENSIONS)
    return (2 * signs - 1).astype("f4")


def _vectors(codes: np.ndarray, trigrams: np.ndarray) -> np.ndarray:
    """Rows of bound vectors for trigrams given as (n, 3) positions in ``codes``."""
    base = np.stack([_letter(int(c)) for c in codes])
    first, second = np.roll(base, 2, axis=1), np.roll(base, 1, axis=1)
    return first[trigrams[:, 0]] * second[trigrams[:, 1]] * base[trigrams[:, 2]]


class Trigrams(NamedTuple):
    """Trigram occurrences: row and number of each; the trigrams by number; rows with letters."""

    rows: np.ndarray
    numbers: np.ndarray
    codes: np.ndarray
    table: np.ndarray
    lettered: np.ndarray


def trigrams(block: Block) -> Trigrams:
    text = np.frombuffer(block.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "u4")
    starts = (block.data & 0xC0) != 0x80
    before = np.concatenate([[0], np.cumsum(starts)])
    offsets = before[block.offsets]
    known = letters()
    # Each row gets a blank in front and one behind.
    symbols = np.where(known.member[text], known.lower[text], BLANK)
    n = block.rows
    symbols = np.insert(symbols, np.concatenate([offsets[:-1], offsets[1:]]), BLANK)
    rows = np.repeat(np.arange(n), np.diff(offsets) + 2)
    lettered = np.bincount(rows, weights=symbols != BLANK, minlength=n) > 0
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != BLANK) | (symbols[:-1] != BLANK) | (rows[1:] != rows[:-1])
    symbols, rows = symbols[keep], rows[keep]
    present = np.zeros(int(symbols.max(initial=0)) + 1, bool)
    present[symbols] = True
    codes = np.flatnonzero(present)
    place = (np.cumsum(present) - 1)[symbols]
    if len(symbols) < 3:
        empty = np.zeros(0, "i8")
        return Trigrams(empty, empty, codes, np.zeros((0, 3), "i8"), lettered)
    place, size = place.astype("i8"), len(codes)
    inside = rows[2:] == rows[:-2]
    packed = ((place[:-2] * size + place[1:-1]) * size + place[2:])[inside]
    if size <= SMALL_ALPHABET:
        present = np.zeros(size**3, bool)
        present[packed] = True
        seen = np.flatnonzero(present)
        number_of = np.zeros(size**3, "i4")
        number_of[seen] = np.arange(len(seen))
        numbers = number_of[packed]
    else:
        seen, numbers = np.unique(packed, return_inverse=True)
    table = np.stack([seen // size**2, seen // size % size, seen % size], axis=1)
    return Trigrams(rows[2:][inside], numbers, codes, table, lettered)


def bundles(found: Trigrams, groups: np.ndarray, n: int) -> np.ndarray:
    """(n, dimensions): the sums of the vectors of each group's trigrams."""
    out = np.zeros((n, DIMENSIONS), "f4")
    step = max(1, CELLS // max(n, DIMENSIONS))
    for at in range(0, len(found.table), step):
        part = found.table[at : at + step]
        here = (found.numbers >= at) & (found.numbers < at + len(part))
        cells = groups[here] * len(part) + (found.numbers[here] - at)
        counts = np.bincount(cells, minlength=n * len(part)).reshape(n, len(part)).astype("f4")
        out += counts @ _vectors(found.codes, part)
    return out


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        languages = np.array(batch.column("lang").to_pylist(), dtype=object)
        for block in blocks(batch.column("text")):
            found = trigrams(block)
            names, of = np.unique(languages[block.first : block.first + block.rows].astype(str), return_inverse=True)
            sums = bundles(found, of[found.rows], len(names))
            for name, vector in zip(names.tolist(), sums, strict=True):
                totals[name] = totals.get(name, 0) + vector.astype("f8")
    if totals:
        flat = np.concatenate(list(totals.values()))
        ends = np.arange(len(totals) + 1, dtype="i4") * DIMENSIONS
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
        yield pa.RecordBatch.from_arrays([pa.array(list(totals)), lists], names=["lang", "vector"])


class Prototypes(NamedTuple):
    languages: list[str]
    vectors: np.ndarray


def learn(rows: DataFrame) -> Prototypes:
    """Prototypes from ``(text, lang)``: unit vectors, less the mean of all."""
    sums = rows.where("lang IS NOT NULL").select("text", "lang")
    sums = sums.mapInArrow(_by_language, "lang string, vector array<double>")
    added = sums.select("lang", F.posexplode("vector").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    table = added.orderBy("lang", "i").toArrow()
    languages = sorted(set(table.column("lang").to_pylist()))
    vectors = table.column("x").to_numpy().reshape(len(languages), -1) if languages else np.zeros((0, DIMENSIONS))
    return Prototypes(languages, _unit(vectors))


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def identify(prototypes: Prototypes, spark) -> Callable[[Column], Column]:
    """A column function from text to ``struct<lang, score>``.

    The score is the cosine of the document with the prototype, between 0 and 1. With several
    languages their common part is taken out of both before they are compared.
    """
    common = prototypes.vectors.mean(axis=0) if len(prototypes.languages) > 1 else np.zeros(DIMENSIONS)
    centred = _unit(prototypes.vectors - common).astype("f4")
    sent = spark.sparkContext.broadcast((prototypes.languages, centred, common.astype("f4")))

    @F.arrow_udf("struct<lang string, score double>")
    def identified(texts: pa.Array) -> pa.Array:
        languages, directions, mean = sent.value
        names, scores = [], []
        for block in blocks(texts):
            found = trigrams(block)
            documents = _unit(bundles(found, found.rows, block.rows)) - mean
            cosines = _unit(documents) @ directions.T
            if not languages:
                names += [UNKNOWN] * block.rows
                scores.append(np.zeros(block.rows))
                continue
            best = cosines.argmax(axis=1)
            names += [languages[b] if ok else UNKNOWN for b, ok in zip(best, found.lettered, strict=True)]
            top = np.clip(cosines[np.arange(block.rows), best], 0, 1)
            scores.append(np.where(found.lettered, top, 0.0))
        score = np.concatenate(scores) if scores else np.zeros(0)
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(score.astype("f8"))], names=["lang", "score"]
        )

    return lambda text: identified(F.coalesce(text, F.lit("")))

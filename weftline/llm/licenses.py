"""Licence texts in documents, by Dice coefficient over word bigrams.

Each line of a document that has words, and the whole document, is a unit; templates are licence
texts and the short notices that name them. A unit's set of word bigrams is compared with a
template's by 2 * common / (unit + template). The coefficient cannot reach the threshold t
unless the sizes a, b satisfy min(a, b) / max(a, b) >= t / (2 - t), so each unit is compared
only with templates within these bounds, and only if it has a bigram of theirs. Templates are
a fixed list, sent to every task; texts never leave theirs.

``passages`` compares every run of words instead, so that a notice counts wherever it stands:
wrapped over lines, behind comment signs, inside a sentence. It is exact. A run of a distinct
bigrams, c of them the template's b, reaches t only if c >= t b / (2 - t) and a - c <= (2 / t - 2) b;
so a text that has too few of a template's bigrams is left out, and what is left is cut where more
foreign bigrams than that lie between two of the template's. In a piece, the runs that end at a word
have as many different sets as bigrams in order of their last place, so one sum along that
order compares them all. A piece costs its words times the template's size.

Defined results: null texts and texts without words have no licence; units of one word have no
bigrams and are never matched; the highest coefficient wins, then the earlier unit (the whole
document last), then the template's name; of runs equally alike that of the larger template wins,
then the one that ends first and is shortest, but a run inside that of another licence's template
twice as large comes after it; repeated rows are scanned each; an empty table gives
an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.llm.word_hashes import LETTERS_DIGITS, Block, blocks, grams, words

THRESHOLD = 0.75
WHOLE = -1

# Licence notices and texts, as (name, text).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file"
        " except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to"
        " in writing, software distributed under the License is distributed on an \"AS IS\" BASIS,"
        " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License"
        " for the specific language governing permissions and limitations under the License.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met: 1. Redistributions of source"
        " code must retain the above copyright notice, this list of conditions and the following"
        " disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,"
        " this list of conditions and the following disclaimer in the documentation and/or other"
        " materials provided with the distribution.",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    (
        "GPL-2.0-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation; either"
        " version 2 of the License, or (at your option) any later version.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the \"Software\"), to deal in the Software"
        " without restriction, including without limitation the rights to use, copy, modify, merge,"
        " publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons"
        " to whom the Software is furnished to do so, subject to the following conditions: The above"
        " copyright notice and this permission notice shall be included in all copies or substantial"
        " portions of the Software.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to"
        " copy, modify, publish, use, compile, sell, or distribute this software, either in source"
        " code form or as a compiled binary, for any purpose, commercial or non-commercial, and by"
        " any means.",
    ),
)

# Notices of licences that the list above does not name.
NOTICES = (
    (
        "AGPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU Affero General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of"
        " the GNU Lesser General Public License as published by the Free Software Foundation; either"
        " version 2.1 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-3.0-or-later",
        "This library is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU Lesser General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version.",
    ),
    (
        "CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related or"
        " neighboring rights to this work.",
    ),
)


def whole_texts() -> tuple[tuple[str, str], ...]:
    """(name, text) of the licences in ``license_texts``, read by the driver."""
    files = sorted((Path(__file__).parent / "license_texts").glob("*.txt"))
    return tuple((f.name.removesuffix(".txt"), f.read_text(encoding="utf-8")) for f in files)


def _bigrams(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bigram) pairs, in order of row."""
    found = words(block, LETTERS_DIGITS)
    hashes, inside = grams(found, 2)
    rows = found.rows[: len(hashes)][inside]
    hashes = hashes[inside]
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[fresh], hashes[fresh]


class Templates(NamedTuple):
    """All templates' bigrams, sorted, with the template of each; and the templates' sizes."""

    names: list[str]
    bigrams: np.ndarray
    owners: np.ndarray
    sizes: np.ndarray


def templates(listed: tuple[tuple[str, str], ...] = TEMPLATES) -> Templates:
    listed = tuple(sorted(listed))
    (block,) = blocks(pa.array([text for _, text in listed]))
    owners, bigrams = _bigrams(block)
    order = np.argsort(bigrams, kind="stable")
    sizes = np.bincount(owners, minlength=len(listed))
    return Templates([name for name, _ in listed], bigrams[order], owners[order], sizes)


def _by_line(block: Block) -> tuple[Block, np.ndarray, np.ndarray]:
    """The block cut into lines, with the row and the number in it of each."""
    breaks = np.flatnonzero(block.data == 10) + 1
    cuts = np.unique(np.concatenate([block.offsets, breaks]))
    owner = np.searchsorted(block.offsets, cuts[:-1], side="right") - 1
    first = np.searchsorted(cuts, block.offsets[owner])
    return Block(0, len(cuts) - 1, block.data, cuts), owner, np.arange(len(cuts) - 1) - first


def _matches(block: Block, known: Templates, threshold: float):
    """(row, template, coefficient) of every match in the block."""
    rows, hashes = _bigrams(block)
    sizes = np.bincount(rows, minlength=block.rows)
    low, high = known.sizes.min(), known.sizes.max()
    ratio = threshold / (2 - threshold)
    sized = (sizes >= ratio * low) & (sizes <= high / ratio)
    keep = sized[rows] if len(rows) else np.zeros(0, bool)
    rows, hashes = rows[keep], hashes[keep]
    first = np.searchsorted(known.bigrams, hashes, side="left")
    last = np.searchsorted(known.bigrams, hashes, side="right")
    hit = last > first
    rows, first, last = rows[hit], first[hit], last[hit]
    # One entry per template that holds the bigram.
    n = last - first
    at = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    pairs, common = np.unique(
        np.repeat(rows, n) * len(known.sizes) + known.owners[at], return_counts=True
    )
    row, template = pairs // len(known.sizes), pairs % len(known.sizes)
    a, b = sizes[row], known.sizes[template]
    near = np.minimum(a, b) >= ratio * np.maximum(a, b)
    dice = 2 * common / (a + b)
    keep = near & (dice >= threshold)
    return row[keep], template[keep], dice[keep]


class Run(NamedTuple):
    """The bigrams ``first`` to ``last`` of a text, and how alike they are to a template."""

    dice: float
    first: int
    last: int


def _best_run(hashes: np.ndarray, hits: np.ndarray, size: int, threshold: float) -> Run | None:
    """The run of ``hashes`` most like a template of ``size`` bigrams that occur at ``hits``."""
    least = threshold / (2 - threshold) * size - 1e-9
    foreign = (2 / threshold - 2) * size + 1e-9
    wide = np.flatnonzero(np.diff(hits) - 1 > foreign)
    apart = [k + 1 for k in wide.tolist() if len(np.unique(hashes[hits[k] + 1 : hits[k + 1]])) > foreign]
    best = None
    for piece in np.split(hits, apart):
        if len(piece) < least:
            continue
        first, last = int(piece[0]), int(piece[-1]) + 1
        distinct, ids = np.unique(hashes[first:last], return_inverse=True)
        member = np.zeros(len(distinct), bool)
        member[ids[piece - first]] = True
        if member.sum() >= least:
            best = _sweep(ids, member, size, threshold, first, best)
    return best


def _sweep(
    ids: np.ndarray, member: np.ndarray, size: int, threshold: float, first: int, best: Run | None
) -> Run | None:
    """The better of ``best`` and the best run of a piece whose first bigram is number ``first``."""
    most = int(size * (2 - threshold) / threshold + 1e-9)
    # Bigrams in order of their last place, the latest last: from lo to hi.
    order, place = np.empty(2 * most + 2, "i8"), np.empty(2 * most + 2, "i8")
    lo = hi = held = 0
    present = bytearray(len(member))
    sizes = np.arange(1, most + 1) + size
    is_member = member.tolist()
    for at, g in enumerate(ids.tolist()):
        if present[g]:
            k = lo + int(np.flatnonzero(order[lo:hi] == g)[0])
            order[k : hi - 1] = order[k + 1 : hi].copy()
            place[k : hi - 1] = place[k + 1 : hi].copy()
            hi -= 1
        else:
            present[g] = 1
            held += is_member[g]
        if hi == len(order):
            order[: hi - lo], place[: hi - lo] = order[lo:hi].copy(), place[lo:hi].copy()
            lo, hi = 0, hi - lo
        order[hi], place[hi] = g, at
        hi += 1
        if hi - lo > most:
            present[order[lo]] = 0
            held -= is_member[order[lo]]
            lo += 1
        bound = 2 * held / (held + size)
        if not is_member[g] or bound < threshold or (best is not None and bound <= best.dice):
            continue
        dice = 2 * np.cumsum(member[order[lo:hi][::-1]]) / sizes[: hi - lo]
        k = int(np.argmax(dice))
        if dice[k] >= threshold and (best is None or dice[k] > best.dice):
            best = Run(float(dice[k]), first + int(place[hi - 1 - k]), first + at)
    return best


def _runs(block: Block, known: Templates, threshold: float):
    """(row, template, dice, line of the first word, line of the last) of every template that
    some run of words in a row reaches the threshold for."""
    found = words(block, LETTERS_DIGITS)
    hashes, inside = grams(found, 2)
    rows = found.rows[: len(hashes)]
    low = np.searchsorted(known.bigrams, hashes, side="left")
    n = np.searchsorted(known.bigrams, hashes, side="right") - low
    hits = np.flatnonzero((n > 0) & inside)
    low, n, of = low[hits], n[hits], rows[hits]
    # Per row the first place of each bigram, so that repeated ones count once.
    order = np.lexsort((hits, hashes[hits], of))
    fresh = np.ones(len(hits), bool)
    fresh[order[1:]] = (of[order[1:]] != of[order[:-1]]) | (hashes[hits[order[1:]]] != hashes[hits[order[:-1]]])
    # One entry per template that holds the bigram.
    at = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    kinds = len(known.sizes)
    pairs = np.repeat(of, n) * kinds + known.owners[at]
    places = np.repeat(hits, n)
    common = np.bincount(pairs[np.repeat(fresh, n)], minlength=block.rows * kinds)
    ratio = threshold / (2 - threshold)
    enough = common >= np.tile(np.maximum(ratio * known.sizes - 1e-9, 1), block.rows)
    taken = enough[pairs]
    pairs, places = pairs[taken], places[taken]
    order = np.argsort(pairs, kind="stable")
    pairs, places = pairs[order], places[order]
    for pair in np.flatnonzero(enough).tolist():
        row, template = divmod(pair, kinds)
        base = found.bounds[row]
        here = places[np.searchsorted(pairs, pair) : np.searchsorted(pairs, pair, side="right")] - base
        run = _best_run(
            hashes[base : found.bounds[row + 1] - 1], here, int(known.sizes[template]), threshold
        )
        if run is not None:
            begin = block.offsets[row]
            lines = [
                int(np.count_nonzero(block.data[begin : found.starts[base + word]] == 10))
                for word in (run.first, run.last + 1)
            ]
            yield row, template, run, *lines


def _ranked(runs: list[tuple], known: Templates) -> list[tuple]:
    """The runs of a text, best first; those that are a small part of another licence's at the end.

    The text of the GPL ends with the notice to use: there it names the GPL, not the notice.
    """

    names, sizes = known.names, known.sizes

    def rank(found: tuple) -> tuple:
        run, template, *_ = found
        part = any(
            other.first <= run.first and run.last <= other.last and 2 * sizes[template] <= sizes[k]
            and names[template] != names[k]
            for other, k, *_ in runs
        )
        return part, -run.dice, -sizes[template], run.last, template

    return sorted(runs, key=rank)


_PASSAGE = [("license", pa.string()), ("dice", pa.float64()), ("line", pa.int64()), ("last_line", pa.int64())]


def passages(
    spark, listed: tuple[tuple[str, str], ...] | None = None, threshold: float = THRESHOLD
) -> Callable[[Column], Column]:
    """A column function from text to ``struct<license, dice, line, last_line, others>``, null for none.

    The licence of the run of words most like a template, and the lines, from 0, where the run
    begins and ends; ``others`` holds the best run of each other licence, the most alike first.
    Without ``listed`` templates are ``TEMPLATES``, ``NOTICES`` and the whole texts.
    """
    listed = (*TEMPLATES, *NOTICES, *whole_texts()) if listed is None else listed
    sent = spark.sparkContext.broadcast(templates(listed))
    passage = "license: string, dice: double, line: bigint, last_line: bigint"

    @F.arrow_udf(f"struct<{passage}, others: array<struct<{passage}>>>")
    def found(texts: pa.Array) -> pa.Array:
        known = sent.value
        out: list[dict | None] = []
        for block in blocks(texts):
            of: list[list] = [[] for _ in range(block.rows)]
            for row, template, run, line, last_line in _runs(block, known, threshold):
                of[row].append((run, template, line, last_line))
            for runs in of:
                best: dict[str, dict] = {}
                for run, template, line, last_line in _ranked(runs, known):
                    name = known.names[template]
                    best.setdefault(name, {"license": name, "dice": run.dice, "line": line, "last_line": last_line})
                first, *others = best.values() or [None]
                out.append(first and first | {"others": others})
        return pa.array(out, pa.struct([*_PASSAGE, ("others", pa.list_(pa.struct(_PASSAGE)))]))

    return lambda text: found(F.coalesce(text, F.lit("")))


def scan(spark, listed: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> Callable[[Column], Column]:
    """A column function from text to ``struct<license, dice, line>``, null for none.

    ``line`` counts from 0; -1 is the whole document.
    """
    sent = spark.sparkContext.broadcast(templates(listed))

    @F.arrow_udf("struct<license string, dice double, line bigint>")
    def scanned(texts: pa.Array) -> pa.Array:
        known = sent.value
        best: list[dict | None] = []
        for block in blocks(texts):
            lines, owner, number = _by_line(block)
            row, template, dice = _matches(lines, known, threshold)
            whole_row, whole_template, whole_dice = _matches(block, known, threshold)
            rows = np.concatenate([owner[row], whole_row])
            line = np.concatenate([number[row], np.full(len(whole_row), WHOLE)])
            template, dice = np.concatenate([template, whole_template]), np.concatenate([dice, whole_dice])
            last = np.where(line == WHOLE, np.iinfo("i8").max, line)
            order = np.lexsort((template, last, -dice, rows))
            found: list[dict | None] = [None] * block.rows
            for k in order[::-1].tolist():
                found[rows[k]] = {
                    "license": known.names[template[k]],
                    "dice": float(dice[k]),
                    "line": int(line[k]),
                }
            best += found
        kind = pa.struct([("license", pa.string()), ("dice", pa.float64()), ("line", pa.int64())])
        return pa.array(best, kind)

    return lambda text: scanned(F.coalesce(text, F.lit("")))

"""Benchmark decontamination by winnowed fingerprints.

A window is 13 consecutive words of a benchmark item; an item of fewer words is one window.
Texts are hashed as runs of five words, and of every nine neighbouring hashes the least one
(the last on ties) is kept as a fingerprint. Thirteen words hold exactly nine such runs, so a
window shared by an item and a document makes both keep the same fingerprint inside it: no
shared window can be missed. Shorter items use runs of ``min(5, words)`` words over their whole
length, in a class of fingerprints of their own; documents are winnowed once for each length
class that the benchmark has.

Each fingerprint carries the words around it, as many as a window can reach. Where fingerprints
of a document and an item meet, the match is extended over these words in both directions, and
counts if it is as long as a window. So no text is joined: a document's fingerprints that pass
the fixed-size filter of the benchmark's are all that leaves its task.

Defined results: null texts have no words and no hits; items without words are ignored, repeated
ones count once, an item without item_id marks words but is not listed; repeated documents are
judged each; empty tables give empty tables or no hits; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.membership import KeyFilter, key_filter
from weftline.llm.rows import without_rows
from weftline.llm.word_hashes import LETTERS_DIGITS, Words, blocks, grams, mix, words
from weftline.shared import Tables

WINDOW = 13
RUN = 5
# Words kept on each side of a fingerprint's first word; none outside its own text.
REACH = WINDOW - 1
CONTEXT = 2 * REACH + 1
NO_WORD = 0


def _keys(runs: np.ndarray, span: int) -> np.ndarray:
    return mix(runs + np.uint64(span))


def winnow(found: Words, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (of words) and keys of the fingerprints for windows of ``span`` words."""
    run = min(RUN, span)
    hashes, _ = grams(found, run)
    width = span - run + 1
    windows = len(found.hashes) - span + 1
    if windows <= 0:
        return np.zeros(0, "i8"), np.zeros(0, "u8")
    keys = _keys(hashes, span)
    last_least = width - 1 - sliding_window_view(keys, width)[:, ::-1].argmin(axis=1)
    rows = found.rows
    whole = rows[:windows] == rows[span - 1 :]
    chosen = np.zeros(len(keys), bool)
    chosen[(np.arange(windows) + last_least)[whole]] = True
    places = np.flatnonzero(chosen)
    return places, keys[places]


def contexts(found: Words, places: np.ndarray) -> np.ndarray:
    """(places, 25) words around each place, 0 beyond the text's ends."""
    rows = found.rows[places]
    at = places[:, None] + np.arange(-REACH, REACH + 1)[None, :]
    inside = (at >= found.bounds[rows][:, None]) & (at < found.bounds[rows + 1][:, None])
    return np.where(inside, found.hashes[np.clip(at, 0, max(0, len(found.hashes) - 1))], NO_WORD)


def _i8(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view("i8"))


def _raw(context: np.ndarray) -> pa.Array:
    width = context.shape[1] * 8
    data = pa.py_buffer(np.ascontiguousarray(context).tobytes())
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(context), [None, data]).cast(
        pa.binary()
    )


def _item_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch.column("text")):
            found = words(block, LETTERS_DIGITS)
            spans = np.minimum(found.counts, WINDOW)
            for span in np.unique(spans[spans > 0]).tolist():
                places, keys = winnow(found, span)
                rows = found.rows[places]
                own = spans[rows] == span
                places, keys, rows = places[own], keys[own], rows[own]
                ids = batch.column("item_id").slice(block.first, block.rows).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.full(len(rows), span, "i4")), _i8(keys), _raw(contexts(found, places))],
                    names=["item_id", "span", "print", "item_words"],
                )


def _document_prints(spans: Sequence[int], wanted: KeyFilter):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                found = words(block, LETTERS_DIGITS)
                places, keys = [np.zeros(0, "i8")], [np.zeros(0, "u8")]
                for span in spans:
                    at, of = winnow(found, span)
                    passed = wanted.passes(of)
                    places.append(at[passed])
                    keys.append(of[passed])
                at, of = np.concatenate(places), np.concatenate(keys)
                order = np.argsort(at, kind="stable")
                at, of = at[order], of[order]
                ends = np.searchsorted(at, found.bounds)
                first = found.bounds[found.rows[at]]
                hits = pa.StructArray.from_arrays(
                    [_i8(of), pa.array((at - first).astype("i8")), _raw(contexts(found, at))],
                    names=["print", "at", "words"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.select(["doc_id", "mark"]).slice(block.first, block.rows).columns,
                        pa.array(found.counts.astype("i8")),
                        pa.ListArray.from_arrays(pa.array(ends.astype("i4")), hits),
                    ],
                    names=["doc_id", "mark", "n_words", "hits"],
                )

    return scan


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matches as long as their window: words [start, end) of a document are an item's."""
    for batch in batches:
        if not len(batch):
            continue
        one, other = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), "u8").reshape(-1, CONTEXT)
            for c in ("words", "item_words")
        )
        same = (one == other) & (one != NO_WORD)
        left = np.cumprod(same[:, REACH - 1 :: -1], axis=1).sum(axis=1)
        right = np.cumprod(same[:, REACH:], axis=1).sum(axis=1)
        at = batch.column("at").to_numpy()
        keep = pa.array((right > 0) & (left + right >= batch.column("span").to_numpy()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("item_id"), pa.array(at - left), pa.array(at + right)],
            names=["row", "item_id", "start", "end"],
        ).filter(keep)


def matched_spans(docs: DataFrame, benchmark: DataFrame, tables: Tables) -> tuple[DataFrame, DataFrame]:
    """``(row, doc_id, mark, n_words)`` of all documents and ``(row, item_id, start, end)`` of matches.

    Spans are in words of the document; together those of a row cover exactly its hit words.
    """
    items = benchmark.select("item_id", "text").dropDuplicates()
    id_type = benchmark.schema["item_id"].dataType.simpleString()
    prints = items.mapInArrow(
        _item_prints, f"item_id {id_type}, span int, print bigint, item_words binary"
    )
    prints = tables.cut(prints, "prints")
    # At most 13 lengths.
    spans = sorted(r["span"] for r in prints.select("span").distinct().collect())
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    scanned = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text").mapInArrow(
        _document_prints(spans, key_filter(prints.select("print").distinct(), "print")),
        f"doc_id {doc_type}, mark bigint, n_words bigint,"
        " hits array<struct<print bigint, at bigint, words binary>>",
    )
    scanned = tables.cut(scanned.withColumn("row", F.monotonically_increasing_id()), "scanned")
    hits = scanned.where(F.size("hits") > 0).select("row", F.inline("hits"))
    meeting = hits.join(prints, "print").select("row", "at", "words", "item_id", "span", "item_words")
    spans_of = meeting.mapInArrow(
        _extended, f"row bigint, item_id {id_type}, start bigint, end bigint"
    )
    spans_of = tables.cut(spans_of.distinct(), "spans")
    return scanned.select("row", "doc_id", "mark", "n_words"), spans_of


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, mark, n_words, n_hit, items, contaminated)`` for every row of ``docs``.

    ``mark`` is a hash of the text; ``items`` are the ids whose windows occur, sorted as strings. A document is contaminated if
    at least a twentieth of its words are hit.
    """
    rows, spans = matched_spans(docs, benchmark, Tables(docs.sparkSession))
    # The distinct spans of one document, of which there are no more than a few per word.
    before = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(before), F.lit(0))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("start"), reached))
    covered = spans.select("row", "start", "end").distinct().withColumn("_fresh", fresh)
    covered = covered.groupBy("row").agg(F.sum("_fresh").alias("n_hit"))
    named = spans.select("row", F.col("item_id").cast("string").alias("item")).distinct()
    named = named.groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    joined = rows.join(covered, "row", "left").join(named, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return joined.select(
        "doc_id",
        "mark",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def clean_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns as they came."""
    found = contamination(docs, benchmark).where("contaminated").select("doc_id", "mark")
    return without_rows(docs, Tables(docs.sparkSession).cut(found.distinct(), "contaminated"))

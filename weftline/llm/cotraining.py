"""Quality of documents by co-training two views.

One view is the text: its distinct words, hashed to 2^16 places. The other is the page's
metadata: source, language, and the sizes of text and lines, as hashed categories. Each view has
a naive Bayes classifier, which is counts only. In every round a view's confident calls on
unlabelled documents (chance above ``CONFIDENT`` or below its complement) become labels for the
other view's next counts; labelled documents always count with their own label.

Afterwards each view's log odds are calibrated (Platt) on labelled documents that were never
trained on, and the views are combined as independent evidence: the calibrated log odds add up,
less the prior that both contain.

All documents take part in every round. Texts are read once, into a table of places; rounds scan
that table, and what leaves a task is one count per place and class, so the counts that reach
the driver have a fixed size. Only rows whose doc_id passes a filter of the labelled ids are
sorted to meet the labels; all others stay where they were written.

Defined results: a null text has no words and size 0; null source or language are values of
their own; labels that disagree are ignored; without labels of both kinds all get 0.5 from a
view without evidence; repeated rows count and score each; rows without doc_id are unlabelled;
an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.folds import labels_of
from weftline.llm.membership import KeyFilter, key_filter
from weftline.llm.word_hashes import NOT_BLANK, blocks, words
from weftline.shared import Tables

ROUNDS = 2
CONFIDENT = 0.95
TEXT_BITS, META_BITS = 16, 12
SMOOTHING = 1.0
# Log odds of a view are kept within this, and counted in bins of a tenth for calibration.
LIMIT = 30.0
BIN = 0.1


def _word_places(sent):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labelled: KeyFilter = sent.value
        for batch in batches:
            maybe = pa.array(labelled.passes(batch.column("mark").to_numpy().view("u8")))
            for block in blocks(batch.column("text")):
                found = words(block, NOT_BLANK)
                places = (found.hashes >> np.uint64(64 - TEXT_BITS)).astype("i8")
                pairs = np.unique((found.rows << TEXT_BITS) + places)
                ends = np.searchsorted(pairs >> TEXT_BITS, np.arange(block.rows + 1)) * 2
                raw = (pairs & (1 << TEXT_BITS) - 1).astype("<u2").tobytes()
                lists = pa.Array.from_buffers(
                    pa.binary(), block.rows, [None, pa.py_buffer(ends.astype("i4").tobytes()), pa.py_buffer(raw)]
                )
                kept = batch.select(["doc_id", "meta"]).slice(block.first, block.rows)
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, lists, maybe.slice(block.first, block.rows)],
                    names=["doc_id", "meta", "words", "maybe"],
                )

    return scan


def _metadata() -> Column:
    """The page's categories, hashed."""
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n"))
    per_line = F.floor(F.log2(size / lines + 1))
    parts = {
        "source": F.col("source").cast("string"),
        "lang": F.col("lang").cast("string"),
        "size": F.floor(F.log2(size + 1)).cast("string"),
        "lines": F.floor(F.log2(lines)).cast("string"),
        "per_line": per_line.cast("string"),
        "shape": F.concat_ws("/", F.col("lang").cast("string"), per_line.cast("string")),
    }
    hashed = [
        F.pmod(F.xxhash64(F.lit(name), F.coalesce(value, F.lit("\x00"))), F.lit(1 << META_BITS)).cast("int")
        for name, value in parts.items()
    ]
    return F.array(*hashed)


class View(NamedTuple):
    """Log odds of each place, and of a document without any."""

    weights: np.ndarray
    prior: float


def _view(negatives: np.ndarray, positives: np.ndarray, n: tuple[int, int]) -> View:
    share = [(c + SMOOTHING) / (m + 2 * SMOOTHING) for c, m in zip((negatives, positives), n, strict=True)]
    prior = float(np.log((n[1] + SMOOTHING) / (n[0] + SMOOTHING)))
    weights = np.log(share[1]) - np.log(share[0])
    return View(np.where(negatives + positives > 0, weights, 0.0), prior)


def _places(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Rows and places of both views."""
    column = batch.column("words")
    bounds = np.frombuffer(column.buffers()[1], "i4")[column.offset : column.offset + len(column) + 1] // 2
    data = column.buffers()[2]
    of_text = np.frombuffer(data, "<u2", count=bounds[-1]) if data is not None and len(data) else np.zeros(0, "u2")
    of_text = of_text[bounds[0] :].astype("i8")
    meta = batch.column("meta")
    n_meta = np.diff(meta.offsets.to_numpy())
    return (
        np.repeat(np.arange(len(column)), np.diff(bounds)),
        of_text,
        np.repeat(np.arange(len(meta)), n_meta),
        meta.flatten().to_numpy().astype("i8"),
    )


def _log_odds(batch: pa.RecordBatch, views: tuple[View, View]) -> np.ndarray:
    """(rows, 2): text view (evidence per word, times its square root) and metadata view."""
    t_rows, t_places, m_rows, m_places = _places(batch)
    n = len(batch)
    words_in = np.maximum(np.bincount(t_rows, minlength=n), 1)
    text = np.bincount(t_rows, weights=views[0].weights[t_places], minlength=n) / np.sqrt(words_in)
    meta = np.bincount(m_rows, weights=views[1].weights[m_places], minlength=n)
    out = np.stack([text + views[0].prior, meta + views[1].prior], axis=1)
    return np.clip(out, -LIMIT, LIMIT)


def _counts(sent, first: bool):
    """Per task: rows and places of each class for either view, as (view, place, class, n)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((2, (1 << bits) + 1), "i8") for bits in (TEXT_BITS, META_BITS)]
        sure = np.log(CONFIDENT / (1 - CONFIDENT))
        for batch in batches:
            label = batch.column("label").fill_null(-1).to_numpy(zero_copy_only=False)
            held = batch.column("held_out").to_numpy(zero_copy_only=False)
            t_rows, t_places, m_rows, m_places = _places(batch)
            targets = [label.copy(), label.copy()]
            if not first:
                odds = _log_odds(batch, sent.value)
                for view in (0, 1):
                    other = odds[:, 1 - view]
                    said = np.where(other >= sure, 1, np.where(other <= -sure, 0, -1))
                    targets[view] = np.where(label >= 0, label, said)
            for view, (rows, places) in enumerate(((t_rows, t_places), (m_rows, m_places))):
                target = np.where(held, -1, targets[view])
                for of in (0, 1):
                    totals[view][of, :-1] += np.bincount(
                        places[target[rows] == of], minlength=totals[view].shape[1] - 1
                    )
                    totals[view][of, -1] += (target == of).sum()
        for view in (0, 1):
            of, place = np.nonzero(totals[view])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(of), view, "i4")),
                    pa.array(place.astype("i4")),
                    pa.array(of.astype("i4")),
                    pa.array(totals[view][of, place]),
                ],
                names=["view", "place", "class", "n"],
            )

    return scan


def _train(rows: DataFrame, views: tuple[View, View] | None) -> tuple[View, View]:
    sent = rows.sparkSession.sparkContext.broadcast(views)
    counts = rows.mapInArrow(_counts(sent, views is None), "view int, place int, class int, n bigint")
    # At most two classes of 2^16 + 2^12 places.
    table = counts.groupBy("view", "place", "class").agg(F.sum("n").alias("n")).toArrow()
    view, place, of, n = (table.column(c).to_numpy() for c in ("view", "place", "class", "n"))
    made = []
    for v, bits in enumerate((TEXT_BITS, META_BITS)):
        totals = np.zeros((2, (1 << bits) + 1))
        mine = view == v
        totals[of[mine], place[mine]] = n[mine]
        made.append(_view(totals[0, :-1], totals[1, :-1], (totals[0, -1], totals[1, -1])))
    return made[0], made[1]


def scored(views: tuple[View, View], spark):
    """A column function from ``(words, meta)`` to the two views' log odds."""
    sent = spark.sparkContext.broadcast(views)

    @F.arrow_udf("struct<text double, meta double>")
    def odds(word_lists: pa.Array, meta: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([word_lists, meta], names=["words", "meta"])
        both = _log_odds(batch, sent.value)
        columns = [pa.array(np.ascontiguousarray(both[:, i])) for i in (0, 1)]
        return pa.StructArray.from_arrays(columns, names=["text", "meta"])

    return odds


def platt(odds: np.ndarray, positives: np.ndarray, totals: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the calibrated log odds, from counts per bin (Newton steps)."""
    a, b = 0.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * odds + b, -LIMIT, LIMIT)))
        error, w = totals * p - positives, totals * p * (1 - p)
        slope = np.array([(error * odds).sum() + 1e-3 * a, error.sum() + 1e-3 * b])
        curve = np.array([[(w * odds * odds).sum() + 1e-3, (w * odds).sum()], [(w * odds).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(curve, slope)
        step *= min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
    return float(a), float(b)


def co_train(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, held_out, text_score, meta_score, score)``: chances of good quality."""
    spark, tables = docs.sparkSession, Tables(docs.sparkSession)
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    marked = labels_of(labels, "quality").select("_doc", F.col("label").cast("int").alias("label"), "held_out")
    marked = tables.cut(marked, "labels")
    # Rows without doc_id have a mark too; it meets no label in the join.
    sent = spark.sparkContext.broadcast(key_filter(marked.select(F.xxhash64("_doc").alias("mark")), "mark"))
    id_mark = F.xxhash64(F.col("doc_id").cast(marked.schema["_doc"].dataType)).alias("mark")
    read = docs.select("doc_id", "text", _metadata().alias("meta"), id_mark)
    kinds = f"doc_id {doc_type}, meta array<int>, words binary, maybe boolean"
    places = tables.cut(read.mapInArrow(_word_places(sent), kinds), "places")
    met = places.where("maybe").join(marked, F.col("doc_id") == F.col("_doc"), "left").drop("_doc", "maybe")
    met = tables.cut(met.withColumn("held_out", F.coalesce("held_out", F.lit(False))), "labelled")
    others = places.where("NOT maybe").drop("maybe").withColumns({"label": F.lit(None).cast("int"), "held_out": F.lit(False)})
    rows = met.unionByName(others)
    views = None
    for _ in range(rounds + 1):
        views = _train(rows, views)
    judged = rows.withColumn("odds", scored(views, spark)("words", "meta"))
    held = judged.where("held_out AND label IS NOT NULL").select("label", F.posexplode(F.array("odds.text", "odds.meta")))
    bins = held.groupBy(F.col("pos").alias("view"), F.round(F.col("col") / BIN).alias("bin")).agg(
        F.sum("label").alias("good"), F.count(F.lit(1)).alias("n")
    )
    seen = bins.toArrow()
    view, at, good, n = (seen.column(c).to_numpy() for c in ("view", "bin", "good", "n"))
    lines = [platt(at[view == v] * BIN, good[view == v], n[view == v]) for v in (0, 1)]
    total = n[view == 0].sum()
    prior = float(np.log((good[view == 0].sum() + 0.5) / (total - good[view == 0].sum() + 0.5)))
    calibrated = [a * F.col(f"odds.{name}") + b for (a, b), name in zip(lines, ("text", "meta"), strict=True)]

    def chance(log_odds: Column) -> Column:
        return 1 / (1 + F.exp(-log_odds))

    return judged.select(
        "doc_id",
        "held_out",
        chance(calibrated[0]).alias("text_score"),
        chance(calibrated[1]).alias("meta_score"),
        chance(calibrated[0] + calibrated[1] - prior).alias("score"),
    )

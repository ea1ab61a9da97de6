"""Toxicity by a counterfactual-regularised linear classifier.

A document is the set of its words and of their first three to six bytes, hashed to 2^20
places. Places are chosen on labelled documents by chi-square against the label; a logistic
model is fitted on those, with a penalty on the squared change of score when an identity term
in a labelled sentence is swapped for another of its group ("swap women for men"). Sentences
that only name a group therefore cannot move the score by which group they name.

The fit reads a bounded sample: the ``TRAIN_ROWS`` labelled documents with the lowest hash of
doc_id. Scoring reads every whole text, as one column expression with a table of 2^20 weights.

Defined results: null and empty texts get the score of a document without known features;
without labelled rows, or with one label only, nothing can be learned and all get the smoothed
share of label 1 (0 without rows); repeated labels count once, disagreeing ones not at all;
rows without doc_id are scored but never trained on; repeated rows score alike; empty tables
give empty tables; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.folds import labels_of
from weftline.llm.word_hashes import NOT_BLANK, blocks, byte_sums, hash_spans, mix, word_bounds
from weftline.shared import Tables

TRAIN_ROWS = 20_000
PLACE_BITS = 20
HEADS = (3, 4, 5, 6)
MAX_PLACES = 2_000
MIN_ROWS = 3
MIN_CHI_SQUARE = 20.0
RIDGE = 2e-4
SWAP_PENALTY = 1.0
STEPS = 400
THRESHOLD = 0.3

# Identity terms by group, lower case.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "transgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "bisexual", "straight"),
    ("black", "white", "asian", "latino"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
)


class Features(NamedTuple):
    """Distinct (row, place) pairs."""

    rows: np.ndarray
    places: np.ndarray


def features(block, wanted: np.ndarray | None = None) -> Features:
    """Places of each row; only those where ``wanted`` is true, if given."""
    alphabet = NOT_BLANK
    # Marks around a word are not part of it.
    member = alphabet.member.copy()
    for mark in b".,;:!?()[]{}\"'#*$%&|<>":
        member[mark] = False
    alphabet = alphabet._replace(member=member)
    starts, ends = word_bounds(block, alphabet)
    folded = alphabet.fold[block.data]
    rows = np.searchsorted(block.offsets, starts, side="right") - 1
    kept_rows, kept_places = [], []
    at = 0
    while at < len(starts):
        base = starts[at]
        to = max(int(np.searchsorted(ends, base + (1 << 19), side="right")), at + 1)
        sums = byte_sums(folded[base : ends[to - 1]])
        first, last, of = starts[at:to] - base, ends[at:to] - base, rows[at:to]
        for head in (0, *HEADS):
            if head:
                longer = last - first > head
                begin, end, own = first[longer], first[longer] + head, of[longer]
            else:
                begin, end, own = first, last, of
            keys = mix(hash_spans(sums, begin, end) + np.uint64(head))
            places = (keys >> np.uint64(64 - PLACE_BITS)).astype("i8")
            if wanted is not None:
                hit = wanted[places]
                own, places = own[hit], places[hit]
            kept_rows.append(own)
            kept_places.append(places)
        at = to
    if not kept_rows:
        return Features(np.zeros(0, "i8"), np.zeros(0, "i8"))
    pairs = np.unique((np.concatenate(kept_rows) << PLACE_BITS) + np.concatenate(kept_places))
    return Features(pairs >> PLACE_BITS, pairs & (1 << PLACE_BITS) - 1)


def _places_of(text: str) -> np.ndarray:
    (block,) = blocks(pa.array([text]))
    return features(block).places


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and place: rows of either label that have it."""
    totals = np.zeros((2, 1 << PLACE_BITS), "i8")
    for batch in batches:
        labels = batch.column("label").to_numpy().astype("i8")
        for block in blocks(batch.column("text")):
            found = features(block)
            of = labels[block.first : block.first + block.rows][found.rows]
            for label in (0, 1):
                totals[label] += np.bincount(found.places[of == label], minlength=1 << PLACE_BITS)
    places = np.flatnonzero(totals.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(places), pa.array(totals[0, places]), pa.array(totals[1, places])],
        names=["place", "negatives", "positives"],
    )


def _lists(wanted: np.ndarray):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                found = features(block, wanted)
                ends = np.searchsorted(found.rows, np.arange(block.rows + 1)).astype("i4")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("label").slice(block.first, block.rows),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(found.places.astype("i4"))),
                    ],
                    names=["label", "places"],
                )

    return scan


def choose_places(sample: DataFrame, n_negative: int, n_positive: int) -> np.ndarray:
    """The places that tell the labels apart best."""
    counts = sample.mapInArrow(_counted, "place bigint, negatives bigint, positives bigint")
    counts = counts.groupBy("place").agg(F.sum("negatives").alias("b"), F.sum("positives").alias("a"))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    c, d = n_positive - a, n_negative - b
    n = float(n_negative + n_positive)
    chi = n * (a * d - b * c) ** 2 / ((a + b) * (c + d) * float(n_negative) * float(n_positive))
    strong = counts.where(F.col("a") + F.col("b") >= MIN_ROWS).withColumn("chi", F.when(c + d > 0, chi))
    strong = strong.where(F.col("chi") >= MIN_CHI_SQUARE).orderBy(F.desc("chi"), "place")
    return np.sort(strong.limit(MAX_PLACES).select("place").toArrow().column("place").to_numpy())


def swaps(sample: DataFrame) -> list[tuple[str, str, int]]:
    """(term, its replacement, labelled sentences that hold the term)."""
    terms = [t for group in IDENTITY_TERMS for t in group]
    sentences = sample.select(F.explode(F.split(F.lower("text"), r"[.!?\n]+")).alias("s"))
    tokens = F.split("s", r"[^\p{L}]+")
    held = sentences.select(F.explode(F.array_intersect(tokens, F.array(*map(F.lit, terms)))).alias("t"))
    counts = {r["t"]: r["n"] for r in held.groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()}
    return [
        (t, other, counts[t])
        for group in IDENTITY_TERMS
        for t in group
        if t in counts
        for other in group
        if other != t
    ]


def fit(
    rows: np.ndarray, places: np.ndarray, labels: np.ndarray, width: int, changes: np.ndarray, weight: np.ndarray
) -> tuple[np.ndarray, float]:
    """Weights and bias of the penalised logistic model, by accelerated gradient steps.

    ``(rows, places)`` are the features present; ``changes`` has a row per swap, the difference
    of its features, and ``weight`` sums to 1 over them. Steps stay below what the whole curvature
    allows, each part of which is at most its trace.
    """
    n = len(labels)
    w, bias = np.zeros(width), float(np.log((labels.sum() + 0.5) / (n - labels.sum() + 0.5)))
    per_row = np.bincount(rows, minlength=n).mean() + 1
    curvature = per_row / 4 + RIDGE
    if len(changes):
        curvature += 2 * SWAP_PENALTY * float(weight @ (changes * changes).sum(axis=1)) / per_row
    rate = 1 / curvature
    seen, seen_bias, last, last_bias = w.copy(), bias, w.copy(), bias
    for step in range(1, STEPS + 1):
        margin = np.bincount(rows, weights=seen[places], minlength=n) + seen_bias
        error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels
        slope = np.bincount(places, weights=error[rows], minlength=width) / n + RIDGE * seen
        if len(changes):
            slope += 2 * SWAP_PENALTY * changes.T @ (weight * (changes @ seen)) / per_row
        w, bias = seen - rate * slope, seen_bias - rate * error.mean()
        momentum = (step - 1) / (step + 2)
        seen, seen_bias = w + momentum * (w - last), bias + momentum * (bias - last_bias)
        last, last_bias = w, bias
    if not (np.isfinite(w).all() and np.isfinite(bias)):
        raise ArithmeticError("the toxicity model's weights are not finite")
    return w, bias


class Model(NamedTuple):
    weights: np.ndarray
    bias: float


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the bounded sample of labelled documents outside the held-out fold."""
    tables = Tables(docs.sparkSession)
    chosen = labels_of(labels, "toxic").where(~F.col("held_out")).orderBy(F.xxhash64("_doc"), "_doc")
    # At most TRAIN_ROWS pairs of numbers, so this side is small whatever the corpus.
    picked = tables.cut(chosen.limit(TRAIN_ROWS).select("_doc", "label"), "picked")
    texts = docs.select("doc_id", "text")
    sample = texts.join(F.broadcast(picked), F.col("doc_id") == F.col("_doc"))
    sample = tables.cut(sample.select("text", F.col("label").cast("int").alias("label")), "sample")
    model = _trained(sample)
    tables.drop(picked, sample)
    return model


def _trained(sample: DataFrame) -> Model:
    weights = np.zeros(1 << PLACE_BITS, "f4")
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    negatives, positives = sizes.get(0, 0), sizes.get(1, 0)
    if not negatives or not positives:
        total = negatives + positives
        return Model(weights, float(np.log((positives + 0.5) / (negatives + 0.5))) if total else -np.inf)
    pairs = swaps(sample)
    of_term = {t: _places_of(t) for pair in pairs for t in pair[:2]}
    places = np.unique(np.concatenate([choose_places(sample, negatives, positives), *of_term.values()]))
    if not len(places):
        return Model(weights, float(np.log((positives + 0.5) / (negatives + 0.5))))
    wanted = np.zeros(1 << PLACE_BITS, bool)
    wanted[places] = True
    table = sample.mapInArrow(_lists(wanted), "label int, places array<int>").toArrow().combine_chunks()
    lists = table.column("places").combine_chunks()
    rows = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    columns = np.searchsorted(places, lists.flatten().to_numpy())
    changes = np.zeros((len(pairs), len(places)))
    for i, (term, other, _) in enumerate(pairs):
        changes[i, np.searchsorted(places, of_term[term])] += 1
        changes[i, np.searchsorted(places, of_term[other])] -= 1
    held = np.array([n for *_, n in pairs], "f8")
    y = table.column("label").to_numpy().astype("f8")
    w, bias = fit(rows, columns, y, len(places), changes, held / held.sum() if len(held) else held)
    weights[places] = w
    return Model(weights, bias)


def score(model: Model, spark) -> callable:
    """A column function from text to the chance of label 1."""
    sent = spark.sparkContext.broadcast((model, model.weights != 0))

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        (weights, bias), wanted = sent.value
        out = np.zeros(len(texts))
        for block in blocks(texts):
            found = features(block, wanted)
            margin = np.bincount(found.rows, weights=weights[found.places], minlength=block.rows) + bias
            with np.errstate(over="ignore"):
                out[block.first : block.first + block.rows] = 1 / (1 + np.exp(-margin))
        return pa.array(out)

    return lambda text: scored(F.coalesce(text, F.lit("")))


def predicted(score: Column) -> Column:
    return (score >= THRESHOLD).cast("int")

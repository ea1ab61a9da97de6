"""K-means (Lloyd) and its quality measures.

Centres are a model of K rows: they come to the driver after each round and go out again as
a constant. Points never do. One pass per round assigns every point and adds it up, so a task
sends K rows on, however many points it read. The arithmetic runs on Arrow batches in numpy:
measured at 100,000 points of 64 dimensions and K = 5 this took 0.5 s against 2.3 s for
array lambdas and 6 s or more for one expression per dimension.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.scalars import sqdist
from weftline.operators.basics import exact_sample

Centres = Sequence[Sequence[float]]


class Fit(NamedTuple):
    centres: list[list[float]]
    iterations: int
    converged: bool


def _square_distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.stack([((points - c) ** 2).sum(axis=1) for c in centres], axis=1)


def _check(centres: Centres) -> np.ndarray:
    table = np.asarray(centres, dtype="float64")
    if table.ndim != 2 or not len(table):
        raise ValueError("centres must be a non-empty list of vectors of one length")
    return table


def assign(points: DataFrame, centres: Centres, vector: str = "v") -> DataFrame:
    """Add ``cluster``, the index of the nearest centre (lowest on ties), and ``sqdist`` to it."""
    table = _check(centres)

    @F.pandas_udf("cluster int, sqdist double")
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        d = _square_distances(np.stack(vectors.to_numpy()), table)
        best = d.argmin(axis=1)
        return pd.DataFrame(
            {"cluster": best.astype("int32"), "sqdist": d[np.arange(len(d)), best]}
        )

    found = points.withColumn("_near", nearest(F.col(vector).cast("array<double>")))
    return found.select("*", "_near.cluster", "_near.sqdist").drop("_near")


def cluster_sums(points: DataFrame, centres: Centres, vector: str = "v") -> DataFrame:
    """``(cluster, dim, n, total, sqdist)``: points, element-wise sum and variation per cluster.

    ``n`` and ``sqdist`` repeat on every ``dim``.
    """
    table = _check(centres)

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(len(table), dtype="int64")
        sums = np.zeros_like(table)
        spread = np.zeros(len(table))
        for batch in batches:
            x = np.stack(batch["v"].to_numpy())
            d = _square_distances(x, table)
            best = d.argmin(axis=1)
            counts += np.bincount(best, minlength=len(table))
            spread += np.bincount(best, d[np.arange(len(d)), best], minlength=len(table))
            sums += (best == np.arange(len(table))[:, None]).astype("float64") @ x
        seen = np.flatnonzero(counts)
        if not len(seen):
            return
        yield pd.DataFrame(
            {
                "cluster": seen.astype("int32"),
                "n": counts[seen],
                "sqdist": spread[seen],
                "sums": list(sums[seen]),
            }
        )

    vectors = points.select(F.col(vector).cast("array<double>").alias("v"))
    parts = vectors.mapInPandas(
        add_up, "cluster int, n bigint, sqdist double, sums array<double>"
    )
    return (
        parts.select("cluster", "n", "sqdist", F.posexplode("sums").alias("dim", "part"))
        .groupBy("cluster", "dim")
        .agg(F.sum("n").alias("n"), F.sum("part").alias("total"), F.sum("sqdist").alias("sqdist"))
    )


def updated_centres(points: DataFrame, centres: Centres, vector: str = "v") -> DataFrame:
    """``(cluster, dim, value)``: the mean of each cluster's points; empty ones are absent."""
    sums = cluster_sums(points, centres, vector)
    return sums.select("cluster", "dim", (F.col("total") / F.col("n")).alias("value"))


def sizes(points: DataFrame, centres: Centres, vector: str = "v") -> DataFrame:
    return assign(points, centres, vector).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


def within_variation(points: DataFrame, centres: Centres, vector: str = "v") -> DataFrame:
    """``wcv``: the sum of squared distances of the points to their nearest centre."""
    return assign(points, centres, vector).agg(F.sum("sqdist").alias("wcv"))


def between_variation(centre_rows: DataFrame, vector: str = "v") -> DataFrame:
    """``bcv``: the sum of squared distances over all pairs of centres, 0 for one.

    No pairs are formed: per dimension the sum over pairs is K times the sum of squares less
    the square of the sum.
    """
    per_dim = (
        centre_rows.select(F.posexplode(vector).alias("dim", "x"))
        .groupBy("dim")
        .agg((F.count("x") * F.sum(F.col("x") * F.col("x")) - F.pow(F.sum("x"), 2)).alias("s"))
    )
    return per_dim.agg(F.coalesce(F.sum("s"), F.lit(0.0)).alias("bcv"))


def centre_table(spark: SparkSession, centres: Centres) -> DataFrame:
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(centres)]
    return spark.createDataFrame(rows, "cluster int, v array<double>")


def shift(old: DataFrame, new: DataFrame) -> DataFrame:
    """``shift``: the summed squared movement of the centres, matched by ``cluster``."""
    pairs = old.select("cluster", F.col("v").alias("a")).join(
        new.select("cluster", F.col("v").alias("b")), "cluster"
    )
    moved = F.sum(sqdist(F.col("a"), F.col("b")))
    return pairs.agg(F.coalesce(moved, F.lit(0.0)).alias("shift"))


def changed(old: DataFrame, new: DataFrame) -> DataFrame:
    """``changed``: is any new centre not exactly among the old ones?"""
    fresh = new.select("v").join(old.select("v"), "v", "left_anti")
    return fresh.agg((F.count(F.lit(1)) > 0).alias("changed"))


def one_round(points: DataFrame, centres: Centres, vector: str = "v") -> list[list[float]]:
    """The centres after one round; a cluster without points keeps its centre."""
    new = [[float(x) for x in c] for c in centres]
    for row in updated_centres(points, centres, vector).collect():  # K x dimensions rows
        new[row["cluster"]][row["dim"]] = row["value"]
    return new


def fit(
    points: DataFrame,
    k: int,
    max_iterations: int,
    start: Centres | None = None,
    tolerance: float | None = None,
    seed: int = 1,
    key: str = "id",
    vector: str = "v",
) -> Fit:
    """Repeat rounds until no centre changes, the shift is within ``tolerance``, or the limit.

    Without ``start``, k points are sampled by a seeded hash of ``key``. The centres returned
    are those of the last update.
    """
    if start is None:
        start = [r[0] for r in exact_sample(points, [key], k, seed).select(vector).collect()]
    centres = _check(start).tolist()
    cached = points.select(vector).persist()
    try:
        for done in range(1, max_iterations + 1):
            new = one_round(cached, centres, vector)
            moved = float(((np.asarray(new) - np.asarray(centres)) ** 2).sum())
            old = {tuple(c) for c in centres}
            centres = new
            if all(tuple(c) in old for c in new) or (tolerance is not None and moved <= tolerance):
                return Fit(centres, done, True)
        return Fit(centres, max_iterations, False)
    finally:
        cached.unpersist()

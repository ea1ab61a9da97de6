"""Polynomials fitted by gradient descent, one step per point, and their errors.

A step on one point changes the coefficients w to w - 2 r (f(w) - y) f with f the powers of
x: an affine map of w. Maps chain, so an epoch over all points, in their order, is one small
matrix. Tasks multiply up the points they hold, the tasks' products are multiplied up in turn,
and thousands of epochs then cost as many products of a (degree + 2)-square matrix with a
vector: exactly the steps of a loop over all points, after one pass over the data.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions.scalars import polynomial

def predict(samples: DataFrame, coefficients: Sequence[float]) -> DataFrame:
    return samples.withColumn("predicted", polynomial(F.col("x"), coefficients))


def squared_error(samples: DataFrame, coefficients: Sequence[float]) -> DataFrame:
    """``sse``: the sum of squared residuals of samples ``(x, y)``."""
    residual = F.col("y") - polynomial(F.col("x"), coefficients)
    return samples.agg(F.sum(residual * residual).alias("sse"))


def moments(samples: DataFrame, degree: int, by: Sequence[str] = ()) -> DataFrame:
    """``n``, ``yy``, sums ``x0..`` of powers of x and ``xy0..`` of y times them, in one pass."""
    powers = [F.lit(1.0)]
    for _ in range(2 * degree):
        powers.append(powers[-1] * F.col("x"))
    sums = [F.sum(p).alias(f"x{i}") for i, p in enumerate(powers)]
    mixed = [F.sum(p * F.col("y")).alias(f"xy{i}") for i, p in enumerate(powers[: degree + 1])]
    yy = F.sum(F.col("y") * F.col("y")).alias("yy")
    return samples.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), yy, *sums, *mixed)


def _product(maps: np.ndarray) -> np.ndarray:
    """The maps applied first to last, multiplied up in pairs."""
    while len(maps) > 1:
        if len(maps) % 2:
            maps = np.concatenate([maps, np.eye(maps.shape[1])[None]])
        maps = maps[1::2] @ maps[0::2]
    return maps[0]


def _epoch_maps(samples: DataFrame, degree: int, rate: float, order_by: Sequence[str]) -> DataFrame:
    """``(key, map)``: the affine map of one epoch over each key's samples in order.

    Samples are range-partitioned on key and order, so a key may fill many tasks; each task
    passes on one product per key it met, and a key's products number at most the partitions.
    """
    side = degree + 2

    def step_maps(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        f = x[:, None] ** np.arange(degree + 1)
        maps = np.tile(np.eye(side), (len(x), 1, 1))
        maps[:, :-1, :-1] -= 2 * rate * f[:, :, None] * f[:, None, :]
        maps[:, :-1, -1] = 2 * rate * y[:, None] * f
        return maps

    def multiply_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        found: dict = {}
        for batch in batches:
            for key, rows in batch.groupby("key", sort=False, dropna=False):
                done = _product(step_maps(rows["x"].to_numpy(), rows["y"].to_numpy()))
                if key not in found and found:
                    # Sorted input: the keys before this one are complete.
                    yield as_rows(found, part)
                    found.clear()
                found[key] = done @ found[key] if key in found else done
        if found:
            yield as_rows(found, part)

    def as_rows(found: dict, part: int) -> pd.DataFrame:
        maps = [m.ravel() for m in found.values()]
        # A NULL key comes as None or NaN; as an object column it goes back as NULL.
        keys = pd.Series([None if pd.isna(k) else k for k in found], dtype=object)
        return pd.DataFrame({"key": keys, "part": part, "map": maps})

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        maps = np.stack(pdf.sort_values("part")["map"].to_numpy()).reshape(-1, side, side)
        return as_rows({pdf["key"].iloc[0]: _product(maps)}, 0)

    schema = f"key {samples.schema['key'].dataType.simpleString()}, part int, map array<double>"
    order = ["key", *order_by, "x", "y"]
    ranged = samples.select(*dict.fromkeys(order)).repartitionByRange(*order)
    ordered = ranged.sortWithinPartitions(*order).select("key", "x", "y")
    products = ordered.mapInPandas(multiply_up, schema)
    return products.groupBy("key").applyInPandas(chain, schema).select("key", "map")


def fit_by_key(
    samples: DataFrame,
    degree: int,
    rate: float,
    order_by: Sequence[str],
    max_epochs: int = 4000,
    target_error: float = 0.01,
    start: Sequence[float] | None = None,
) -> DataFrame:
    """``(key, coefficients, epochs, sse)``: a polynomial per key of ``(key, x, y)`` samples.

    Points are taken in the order of ``order_by``, then of x and y. Descent ends when an
    epoch changes nothing, the squared error is at most ``target_error``, or after
    ``max_epochs``. It starts from zeros unless ``start`` is given. A rate too high for the
    data diverges, and the result then holds infinities or NaN.
    """
    side = degree + 2
    first = [0.0] * (degree + 1) if start is None else [float(c) for c in start]
    if len(first) != degree + 1:
        raise ValueError("start needs degree + 1 coefficients")

    def descend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.to_dict("records"):
                epoch = np.asarray(r["map"]).reshape(side, side)
                gram = np.array(
                    [[r[f"x{i + j}"] for j in range(degree + 1)] for i in range(degree + 1)]
                )
                xy = np.array([r[f"xy{i}"] for i in range(degree + 1)])
                w, epochs, sse = np.array([*first, 1.0]), 0, np.inf
                with np.errstate(all="ignore"):
                    while epochs < max_epochs and not sse <= target_error:
                        new = epoch @ w
                        epochs += 1
                        c = new[:-1]
                        sse = float(max(r["yy"] - 2 * c @ xy + c @ gram @ c, 0.0))
                        same = np.array_equal(new, w)
                        w = new
                        if same or not np.isfinite(w).all():
                            break
                rows.append((r["key"], w[:-1], epochs, sse))
            yield pd.DataFrame(rows, columns=["key", "coefficients", "epochs", "sse"])

    maps = _epoch_maps(samples, degree, rate, order_by)
    sums = moments(samples, degree, ["key"]).withColumnRenamed("key", "_key")
    joined = maps.join(sums, F.col("key").eqNullSafe(F.col("_key"))).drop("_key")
    key_type = samples.schema["key"].dataType.simpleString()
    return joined.mapInPandas(
        descend, f"key {key_type}, coefficients array<double>, epochs int, sse double"
    )


def fit(samples: DataFrame, degree: int, rate: float, order_by: Sequence[str], **stop) -> DataFrame:
    """``(coefficients, epochs, sse)``: one polynomial for all samples ``(x, y)``."""
    return fit_by_key(samples.withColumn("key", F.lit(0)), degree, rate, order_by, **stop).drop("key")

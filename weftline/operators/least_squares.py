"""Polynomials of least squares in closed form, overall or per key.

Each task triangulates the rows of the design matrix that it reads (QR, a batch at a time, so it
holds one small triangle per key), the keys' triangles are triangulated in turn, and the last one
gives the coefficients: the tree of a tall and narrow QR. Powers of x are replaced by Legendre
polynomials of x scaled to [-1, 1], and no normal equations are formed, so high degrees stay
accurate where sums of powers would not.

Defined results: rows without x or y, or with one that is not a finite number, are left out; a key
without other rows has no fit; with fewer different x than coefficients it is the least ones in
Legendre form.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from numpy.polynomial import Polynomial, legendre
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys whose triangles a task holds before it sends them on.
KEYS_HELD = 4_096

_TRIANGLE = "n bigint, triangle array<double>"


def _triangles(degree: int, lo: float, hi: float):
    scale, shift = (2 / (hi - lo), -(hi + lo) / (hi - lo)) if hi > lo else (0.0, 0.0)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        kind = None

        def out() -> pa.RecordBatch:
            rows = [r.ravel().tolist() for _, r in held.values()]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), kind), pa.array([n for n, _ in held.values()], pa.int64()), pa.array(rows, pa.list_(pa.float64()))],
                names=["key", "n", "triangle"],
            )

        for batch in batches:
            kind = batch.column("key").type
            if not len(batch):
                continue
            x, y = batch.column("x").to_numpy(), batch.column("y").to_numpy()
            names = batch.column("key").dictionary_encode()
            of = names.indices.fill_null(-1).to_numpy()
            design = np.column_stack([legendre.legvander(x * scale + shift, degree), y])
            for k in np.unique(of):
                mine = design[of == k]
                key = names.dictionary[int(k)].as_py() if k >= 0 else None
                n, before = held.get(key, (0, np.zeros((0, degree + 2))))
                held[key] = (n + len(mine), np.linalg.qr(np.vstack([before, mine]), mode="r"))
            if len(held) >= KEYS_HELD:
                yield out()
                held = {}
        if held:
            yield out()

    return scan


def _solved(degree: int, lo: float, hi: float):
    width = degree + 2

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        stacked = np.vstack([np.reshape(t, (-1, width)) for t in rows["triangle"]])
        r = np.linalg.qr(stacked, mode="r")
        coefficients, *_ = np.linalg.lstsq(r[:, :-1], r[:, -1], rcond=1e-12)
        rest = r[:, :-1] @ coefficients - r[:, -1]
        line = Polynomial([-(hi + lo) / (hi - lo), 2 / (hi - lo)]) if hi > lo else Polynomial([0.0])
        powers = np.zeros(width - 1)
        found = Polynomial(legendre.leg2poly(coefficients))(line)
        found = found.coef if isinstance(found, Polynomial) else np.atleast_1d(found)
        powers[: len(found)] = found
        return pd.DataFrame(
            {"key": rows["key"].iloc[:1], "n": [int(rows["n"].sum())], "coefficients": [powers.tolist()], "sse": [float(rest @ rest)]}
        )

    return solve


def fit_by_key(samples: DataFrame, degree: int) -> DataFrame:
    """``(key, n, coefficients, sse)`` of ``(key, x, y)``, coefficients by ascending power."""
    kind = samples.schema["key"].dataType.simpleString()
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    rows = samples.select("key", x.alias("x"), y.alias("y"))
    # A null is not below infinity either.
    rows = rows.where((F.abs("x") < float("inf")) & (F.abs("y") < float("inf")))
    lo, hi = rows.agg(F.min("x"), F.max("x")).first()
    lo, hi = (0.0, 0.0) if lo is None else (lo, hi)
    parts = rows.mapInArrow(_triangles(degree, lo, hi), f"key {kind}, {_TRIANGLE}")
    fitted = f"key {kind}, n bigint, coefficients array<double>, sse double"
    return parts.groupBy("key").applyInPandas(_solved(degree, lo, hi), fitted)


def fit(samples: DataFrame, degree: int) -> DataFrame:
    """``(n, coefficients, sse)`` of ``(x, y)``."""
    return fit_by_key(samples.withColumn("key", F.lit(0)), degree).drop("key")

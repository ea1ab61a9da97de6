"""CUR decomposition of a matrix ``(r, c, v)``: a few of its columns, a link matrix, a few of its rows.

Rows and columns are drawn without replacement, with chances that follow their squared norms: each
gets a weighted key from a seeded hash, and the lowest keys are taken. With the drawn columns C and
rows R the link matrix is U = C+ A R+, which makes the Frobenius norm of A - C U R least.

C+ and R+ come from triangles: tasks triangulate the rows they read, a batch at a time, and triangles
are triangulated in turn (a tall and narrow QR as a tree). C and A R^T stand side by side in one such
QR, so neither C^T C nor any matrix with a row per row of A is formed on the driver; what reaches it
are triangles of the sizes drawn. The error follows from them too: the squared norm of A less that of
its projection, so a relative error below about 1e-8 is not told from 0.

``v`` is a number per cell, absent cells are 0; entries without r, c or v count for nothing. Cells
must be unique, and NaN or infinite values are refused. Rows and columns of norm 0 are never drawn,
so fewer may be drawn than asked for; with dependent columns or rows U is the least of the best ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.shared import Tables

# Groups in which triangles of tasks meet before the last one.
BRANCHES = 32
# Singular values below this share of the largest count as 0.
_RANK = 1e-10


class Cur(NamedTuple):
    rows: list[int]
    columns: list[int]
    link: np.ndarray  # a row per drawn column, a column per drawn row
    norm: float
    error: float  # of A - C U R, relative to the norm of A


def drawn(entries: DataFrame, axis: str, k: int, seed: int) -> DataFrame:
    """``(pos, id, norm2)``: at most ``k`` rows or columns (``axis`` r or c), by weighted keys."""
    norms = entries.groupBy(F.col(axis).alias("id")).agg(F.sum(F.col("v") * F.col("v")).alias("norm2"))
    name = F.concat_ws(":", F.lit(str(seed)), F.lit(axis), F.col("id").cast("string"))
    unit = (F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") + 1) / float(2**32 + 1)
    keyed = norms.where("id IS NOT NULL AND norm2 > 0").withColumn("key", -F.log(unit) / F.col("norm2"))
    first = keyed.orderBy("key", "id").limit(k)
    listed = first.agg(F.sort_array(F.collect_list(F.struct("key", "id", "norm2"))).alias("all"))
    return listed.select(F.posexplode("all").alias("pos", "x")).select("pos", "x.id", "x.norm2")


def _in_place(axis: str, chosen: list[int]) -> list:
    """One sum per chosen row or column: its value where there is one."""
    return [F.sum(F.when(F.col(axis) == x, F.col("v")).otherwise(0.0)) for x in chosen]


def _triangulated(width: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, width))
        for batch in batches:
            rows = batch.column("row").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            held = np.linalg.qr(np.vstack([held, rows]), mode="r")
        if len(held):
            yield pa.RecordBatch.from_pydict({"triangle": pa.array([held.ravel()], pa.list_(pa.float64()))})

    return scan


def _joined(width: int):
    def join(parts: pd.DataFrame) -> pd.DataFrame:
        held = np.zeros((0, width))
        for part in parts["triangle"]:
            held = np.linalg.qr(np.vstack([held, np.reshape(part, (-1, width))]), mode="r")
        return pd.DataFrame({"triangle": [held.ravel()]})

    return join


def triangle(rows: DataFrame, width: int) -> np.ndarray:
    """R of the QR of the matrix whose rows are the arrays ``row``, padded with zero rows."""
    parts = rows.select("row").mapInArrow(_triangulated(width), "triangle array<double>")
    for groups in (BRANCHES, 1):
        branch = F.pmod(F.xxhash64("triangle"), F.lit(groups))
        parts = parts.groupBy(branch).applyInPandas(_joined(width), "triangle array<double>")
    last = parts.first()
    found = np.zeros((width, width))
    if last is not None:
        r = np.reshape(last["triangle"], (-1, width))
        found[: len(r)] = r
    return found


def cur(entries: DataFrame, rows: int, columns: int, seed: int) -> Cur:
    """Decompose with so many drawn rows and columns (some hundreds at most: U is made on the driver)."""
    tables = Tables(entries.sparkSession)
    cells = entries.selectExpr("r", "c", "CAST(v AS DOUBLE) AS v").where("r IS NOT NULL AND c IS NOT NULL AND v IS NOT NULL")
    total = cells.agg(F.sum(F.col("v") * F.col("v"))).first()[0] or 0.0
    if not math.isfinite(total):
        raise ValueError("the matrix has a value that is not a finite number")
    r_ids, c_ids = ([x["id"] for x in drawn(cells, a, k, seed).orderBy("pos").collect()] for a, k in (("r", rows), ("c", columns)))
    if not r_ids:
        return Cur([], [], np.zeros((0, 0)), 0.0, 0.0)

    # R by its columns: as many numbers each as rows were drawn.
    by_column = cells.where(F.col("r").isin(r_ids)).groupBy("c").agg(F.array(*_in_place("r", r_ids)).alias("row"))
    by_column = tables.cut(by_column, "rows")
    t = triangle(by_column, len(r_ids))
    # Each row of C and of A R^T, from one pass over the cells.
    met = cells.join(by_column, "c", "left")
    products = [F.sum(F.col("v") * F.coalesce(F.get("row", F.lit(i)), F.lit(0.0))) for i in range(len(r_ids))]
    sides = met.groupBy("r").agg(F.array(*_in_place("c", c_ids), *products).alias("row"))
    both = triangle(sides, len(c_ids) + len(r_ids))
    tables.drop(by_column)

    k = len(c_ids)
    x, sigma, y = np.linalg.svd(both[:k, :k])
    kept = sigma > _RANK * sigma[0]
    core = x[:, kept].T @ both[:k, k:] @ np.linalg.pinv(t, rcond=_RANK)
    link = (y[kept].T / sigma[kept]) @ core @ np.linalg.pinv(t, rcond=_RANK).T
    rest = max(total - float((core * core).sum()), 0.0)
    return Cur(r_ids, c_ids, link, math.sqrt(total), math.sqrt(rest / total))


def link_table(spark: SparkSession, found: Cur) -> DataFrame:
    """``(col_pos, row_pos, c, r, u)``: the link matrix by drawn columns and rows."""
    cells = [
        (j, i, c, r, float(found.link[j, i])) for j, c in enumerate(found.columns) for i, r in enumerate(found.rows)
    ]
    return spark.createDataFrame(cells, "col_pos int, row_pos int, c bigint, r bigint, u double")


def approximated(entries: DataFrame, found: Cur) -> DataFrame:
    """``(r, c, v, approx)`` for the cells given, which hold the drawn rows and columns."""
    cells = entries.select("r", "c", F.col("v").cast("double").alias("v"))
    if not found.rows:
        return cells.withColumn("approx", F.lit(0.0))
    of_row = cells.where(F.col("c").isin(found.columns)).groupBy("r").agg(F.array(*_in_place("c", found.columns)).alias("_c"))
    in_row = cells.where(F.col("r").isin(found.rows)).groupBy("c").agg(F.array(*_in_place("r", found.rows)).alias("_r"))
    linked = F.array(
        *[sum((F.get("_r", F.lit(i)) * float(u) for i, u in enumerate(row)), F.lit(0.0)) for row in found.link]
    )
    tables = Tables(entries.sparkSession)
    of_row, in_row = tables.cut(of_row, "columns"), tables.cut(in_row.select("c", linked.alias("_r")), "rows")
    met = cells.join(of_row, "r", "left").join(in_row, "c", "left")
    product = F.aggregate(F.zip_with("_c", "_r", lambda a, b: a * b), F.lit(0.0), lambda s, p: s + p)
    return met.select("r", "c", "v", F.coalesce(product, F.lit(0.0)).alias("approx"))

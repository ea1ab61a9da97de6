"""The fold that is held out, and labels as one row per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS, HELD_OUT = 4, 2


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves the held-out remainder; not without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def labels_of(labels: DataFrame, label: str) -> DataFrame:
    """``(_doc, label, held_out)``: documents whose labels agree, each once."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    agreed = rows.groupBy(F.col("doc_id").alias("_doc")).agg(
        F.min(label).alias("label"), F.max(label).alias("_most")
    )
    return agreed.where("label = _most").select("_doc", "label", held_out(F.col("_doc")).alias("held_out"))

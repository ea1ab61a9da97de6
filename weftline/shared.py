"""Tables written to the folder all executors share.

Iterative operators cut their lineage by writing each round's state as a table and
reading it back: the state survives lost executors, is computed once, and the reader
knows its size, so joins against it are planned from real numbers.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_FILE = 500_000


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; if unset, the session's warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/weftline/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str = "state") -> DataFrame:
    """Write ``df`` to the shared folder and return a reader of it."""
    return Tables(df.sparkSession).cut(df, label)


class Tables:
    """The written tables of one operator call; those no later result reads can be dropped."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def cut(self, df: DataFrame, label: str = "state", rows: int | None = None) -> DataFrame:
        """Write ``df``. With an upper bound of its ``rows``, small tables are few files.

        The rows are dealt to the files once they are made, so whatever makes them keeps its tasks;
        for wide rows leave ``rows`` out.
        """
        path = new_path(self.spark, label)
        files = None if rows is None else max(1, math.ceil(rows / ROWS_PER_FILE))
        (df if files is None else df.repartition(files)).write.parquet(path)
        written = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(written)] = (written, path)
        return written

    def drop(self, *written: DataFrame | None) -> None:
        """Delete tables made by ``cut``; frames made by anything else are left alone."""
        for df in written:
            kept = self._paths.pop(id(df), None)
            if kept is not None:
                remove(self.spark, kept[1])


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table below the shared folder through the file system that holds it."""
    if not path.startswith(f"{shared_dir(spark)}/weftline/"):
        raise ValueError(f"not a table of this library: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def is_folder(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).isDirectory()

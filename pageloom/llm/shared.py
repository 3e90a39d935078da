"""Helpers of the operators in this folder: shared storage and Arrow batches."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and text bytes that one step of a Python task holds at a time.
STEP_ROWS = 1000
STEP_BYTES = 2 << 20


def let_workers_import(spark: SparkSession) -> None:
    """Puts this package on the search path of Python workers that run on the same machine as the driver.

    On a cluster the package is shipped with ``--py-files``; the path then does no harm.
    """
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known.get("PYTHONPATH", "")]))


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see, from ``spark.checkpoint.dir``.

    Only where none is set on one machine (tests), a temporary folder is made and set; a cluster needs the setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="pageloom-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; every call gives another one."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back, so that lost executors cost no rework."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """A name for a column of our own that no column of ``df`` has, in any case of letters."""
    known = {c.lower() for c in df.columns}
    while name.lower() in known:
        name += "_"
    return name


def text_of(column: str) -> Column:
    """A text column with null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def steps(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most STEP_ROWS rows and about STEP_BYTES bytes of text (one row at least)."""
    for batch in batches:
        column = batch.column(text)
        per_row = max(1, column.nbytes // max(1, len(column)))
        rows = max(1, min(STEP_ROWS, STEP_BYTES // per_row))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    pa.default_memory_pool().release_unused()


class Memo(dict):
    """A dict that computes missing values and remembers about twice ``limit`` of them.

    When it is full, its entries become the old ones; of those, only what is asked for again is kept.
    """

    __slots__ = ("limit", "make", "old")

    def __init__(self, make: Callable, limit: int) -> None:
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def trim(self) -> None:
        """To be called now and then; between calls the dict may grow."""
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()

"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from pulsebook.session import work_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its statement where SQL can express it."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def slices(batches, rows: int = 256):
    """The batches in pieces of few rows, so that a task holds few texts as Python strings at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


@contextmanager
def few_at_a_time(spark: SparkSession, rows: int = 1024):
    """Whole texts go to Python in batches of few rows, of which a task holds one on each side, while this lasts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= rows:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


STAGED: list[str] = []


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage so that a lost executor costs one task, not the plan, and fixes values
    that a second evaluation could give otherwise (row numbers, task numbers).
    """
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    STAGED.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def identified(df: DataFrame, name: str = "numbered") -> DataFrame:
    """The rows as ``row``, with an ``id`` that is the same in every evaluation.

    A row of a file is known by file and number; rows that come from elsewhere are written first.
    """
    packed = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")
    try:
        return df.select(packed, F.struct("_metadata.file_path", "_metadata.row_index").alias("id"))
    except AnalysisException:
        written = stage(df.select(packed), name)
        return written.select("row", F.struct("_metadata.file_path", "_metadata.row_index").alias("id"))


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Remove staged tables that nothing reads any more."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        STAGED.remove(p)


_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (SplitMix64's finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= _A
    x ^= x >> np.uint64(27)
    x *= _B
    x ^= x >> np.uint64(31)
    return x

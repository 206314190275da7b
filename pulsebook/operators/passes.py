"""Python passes over Arrow batches whose rows come in order of their key."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pulsebook.operators.timeline import Timeline
from pulsebook.session import work_folder


def in_order(line: Timeline) -> DataFrame:
    """Rows of each (key, slice) in one partition, in order."""
    return line.df.repartition(*line.parts).sortWithinPartitions(*line.parts, *line.order)


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder.

    What follows a Python pass reads its rows several times, under different conditions, so that no exchange is
    shared: without the table the pass would run once for each. A lost executor then costs no pass either.
    """
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def key_at(batch: pa.RecordBatch, parts: list[str], i: int) -> tuple:
    return tuple(batch.column(c)[i].as_py() for c in parts)


def group_starts(batch: pa.RecordBatch, parts: list[str], last: tuple | None) -> list[bool]:
    """Which rows of a sorted batch begin a new group, given the last group of the batch before."""
    n = batch.num_rows
    new = np.zeros(n, dtype=bool)
    for c in parts:
        here, before = batch.column(c).slice(1), batch.column(c).slice(0, n - 1)
        differs = pc.fill_null(pc.not_equal(here, before), False)
        nulls = pc.xor(pc.is_null(here), pc.is_null(before))
        new[1:] |= pc.or_(differs, nulls).to_numpy(zero_copy_only=False)
    new[0] = last is None or key_at(batch, parts, 0) != last
    return new.tolist()


def floats(batch: pa.RecordBatch, name: str) -> list[float]:
    """A column as floats, nan for null."""
    return batch.column(name).cast(pa.float64()).to_numpy(zero_copy_only=False).tolist()


def record_batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=to_arrow_schema(schema))

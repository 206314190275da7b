"""Rows that came before others of an earlier time, put back in order.

A stream's mark is its newest time less the allowed lateness. Rows before the mark are released, in no particular
order but all later than those released before; rows from the mark on wait for a later batch. A row that comes when
the mark has passed it is too late, as is one without a time, and is handed out apart.

So with an allowed lateness of nothing the rows of the newest time wait: a poll whose rows come in two batches is
whole when it is released.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsebook.functions.timecols import epoch_us
from pulsebook.streaming.tables import Records


def micros(df: DataFrame, time: str) -> Column:
    naive = isinstance(df.schema[time].dataType, T.TimestampNTZType)
    return epoch_us(time) if naive else F.unix_micros(time)


class Waiting:
    """The rows of a stream that wait, and its mark, kept batch by batch."""

    def __init__(self, spark: SparkSession, path: str, time: str, delay: float) -> None:
        self.spark, self.path, self.time = spark, path, time
        self.delay = round(delay * 1_000_000)
        self.records = Records(spark, path)

    def release(self, batch: DataFrame, number: int) -> tuple[DataFrame, DataFrame, int | None]:
        """Rows in their turn, rows too late, and the mark in microseconds, none before any time was seen.

        The batch is read several times, so it should be held.
        """
        before = self.records.before(number)
        mark = before["mark"] if before else None
        at = micros(batch, self.time)
        late = at.isNull() if mark is None else at.isNull() | (at < mark)
        rows = batch.filter(~late)
        if before:
            rows = rows.unionByName(self.spark.read.schema(batch.schema).parquet(f"{self.path}/data/{number - 1:012d}"))
        newest = batch.agg(F.max(at)).first()[0]
        known = [m for m in (mark, None if newest is None else newest - self.delay) if m is not None]
        now = max(known, default=None)
        waits = rows if now is None else rows.filter(at >= now)
        waits.write.mode("overwrite").parquet(f"{self.path}/data/{number:012d}")
        self.records.write(number, {"mark": now})
        kept = {f"{n:012d}" for n in self.records.numbers()}
        for name in self.records.children(f"{self.path}/data"):
            if name not in kept:
                self.records.delete(f"{self.path}/data/{name}")
        return rows.limit(0) if now is None else rows.filter(at < now), batch.filter(late), now

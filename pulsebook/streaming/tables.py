"""Tables kept by streams: current state and journals."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from pulsebook.operators.cells import cell_events
from pulsebook.operators.current import latest
from pulsebook.sources.logs import in_line_order
from pulsebook.sources.sinks import journal

KEPT = 2
BUCKETS = 64
BUCKET = "_bucket"


class Records:
    """What each batch left behind, one small text per batch, written last.

    A batch counts once its record is there. The newest two are kept, for a batch that runs again and for readers
    still on the older one. A batch other than the first must find the record of the one before it: without it the
    state is lost, and that is an error, not a new start.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path, self._jvm = path, spark._jvm
        self._folder = self._path(f"{path}/done")
        self.fs = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _of(self, number: int):
        return self._path(f"{self.path}/done/{number:012d}")

    def numbers(self) -> list[int]:
        if not self.fs.exists(self._folder):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(self._folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def read(self, number: int) -> dict:
        stream = self.fs.open(self._of(number))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def newest(self) -> dict | None:
        done = self.numbers()
        return self.read(done[-1]) if done else None

    def before(self, number: int) -> dict | None:
        if number == 0:
            return None
        if number - 1 not in self.numbers():
            raise FileNotFoundError(f"{self.path} has no record of batch {number - 1}; its state is lost")
        return self.read(number - 1)

    def write(self, number: int, content: dict) -> None:
        """Records of later batches are another run's, of which nothing is left."""
        draft = self._path(f"{self.path}/done/.{number:012d}")
        stream = self.fs.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        self.fs.delete(self._of(number), False)
        self.fs.rename(draft, self._of(number))
        done = self.numbers()
        for other in [n for n in done if n > number] + [n for n in done if n <= number][:-KEPT]:
            self.fs.delete(self._of(other), False)

    def children(self, path: str) -> list[str]:
        folder = self._path(path)
        return [s.getPath().getName() for s in self.fs.listStatus(folder)] if self.fs.exists(folder) else []

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)


class CurrentTable:
    """A table whose rows lie in buckets of keys; a batch writes anew only the buckets it touches.

    A batch reads what the batch before left and writes under its own number, so a batch that is run again finds the
    same input. Its record names the batch that each bucket was last written by. Without a key there is one bucket.
    """

    def __init__(self, spark: SparkSession, path: str, key: str | list[str] | None = None, buckets: int = BUCKETS) -> None:
        self.spark, self.path = spark, path
        self.key = [key] if isinstance(key, str) else list(key or [])
        self.buckets = buckets if self.key else 1
        self.records = Records(spark, path)

    def _rows(self, record: dict | None, buckets: list[int] | None = None) -> DataFrame | None:
        if record is None:
            return None
        schema = T.StructType.fromJson(record["schema"])
        wanted = {int(b): n for b, n in record["buckets"].items() if buckets is None or int(b) in buckets}
        if not wanted:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/data/{n:012d}/{BUCKET}={b}" for b, n in sorted(wanted.items())]
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self, before: int | None = None) -> DataFrame | None:
        """The rows after the newest batch, or as they were before a batch."""
        return self._rows(self.records.newest() if before is None else self.records.before(before))

    def replace(self, df: DataFrame, batch: int) -> None:
        """All rows anew."""
        self._write(df, batch, {})

    def merge(self, new: DataFrame, batch: int, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """``combine(old, new)`` in place of the rows of all buckets that ``new`` has keys of."""
        record = self.records.before(batch)
        if record is None:
            self._write(combine(new.limit(0), new), batch, {})
            return
        touched = [r[0] for r in new.select(self._bucket().alias(BUCKET)).distinct().collect()]
        old = self._rows(record, touched)
        self._write(combine(old, new), batch, {b: n for b, n in record["buckets"].items() if int(b) not in touched})

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int") if self.key else F.lit(0)

    def _write(self, rows: DataFrame, batch: int, others: dict) -> None:
        at = f"{self.path}/data/{batch:012d}"
        placed = rows.withColumn(BUCKET, self._bucket())
        # A bucket may be large: rebalancing splits it where that pays.
        placed.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(at)
        written = {name.split("=")[1]: batch for name in self.records.children(at) if name.startswith(f"{BUCKET}=")}
        self.records.write(batch, {"schema": rows.schema.jsonValue(), "buckets": others | written})
        self._clean()

    def _clean(self) -> None:
        """Remove buckets that no kept record names."""
        kept = {(int(b), n) for number in self.records.numbers() for b, n in self.records.read(number)["buckets"].items()}
        for name in self.records.children(f"{self.path}/data"):
            at = f"{self.path}/data/{name}"
            inside = {c: (int(c.split("=")[1]), int(name)) for c in self.records.children(at) if c.startswith(f"{BUCKET}=")}
            gone = [c for c, of in inside.items() if of not in kept]
            if len(gone) == len(inside):
                self.records.delete(at)
            else:
                for c in gone:
                    self.records.delete(f"{at}/{c}")


def _merging(path: str, key, merge: Callable[[DataFrame], DataFrame], prepare: Callable[[DataFrame], DataFrame]):
    """Each batch, prepared to about one row per key, into the table at ``path``."""

    def write(batch: DataFrame, number: int) -> None:
        table = CurrentTable(batch.sparkSession, path, key)
        new = prepare(batch).persist()
        try:
            table.merge(new, number, lambda old, rows: merge(old.unionByName(rows)))
        finally:
            new.unpersist()

    return write


def stream_latest(stream: DataFrame, key, time: str, path: str, tie: str | None = None) -> DataStreamWriter:
    """Current state as a table: the batch is cut to one row per key before it meets the old rows."""

    def last(rows: DataFrame) -> DataFrame:
        return latest(rows, key, time, tie)

    return stream.writeStream.foreachBatch(_merging(path, key, last, last))


def stream_cell_events(lines: DataFrame, path: str, strict: bool = True) -> DataStreamWriter:
    """Last logged event per station as a table; the state outlives the daily change of logs."""
    station = ["controller", "cell"]

    def events(batch: DataFrame) -> DataFrame:
        lines = in_line_order(batch) if "block" in batch.columns else batch
        line = F.struct("log_date", "line_no", "event")
        last = F.max_by(line, F.struct("log_date", "line_no", "nth")).alias("_last")
        return cell_events(lines, strict).groupBy(*station).agg(last).select(*station, "_last.*")

    def last(rows: DataFrame) -> DataFrame:
        return latest(rows, station, "log_date", "line_no")

    return lines.writeStream.foreachBatch(_merging(path, station, last, events))


def journal_sink(hot_path: str, archive_path: str, time: str) -> Callable[[DataFrame, int], None]:
    """Write a batch's changes into both journals, once however often it is run."""

    def write(batch: DataFrame, number: int) -> None:
        journal(batch, hot_path, archive_path, time, f"batch-{number}")

    return write


def stream_journal(changes: DataFrame, hot_path: str, archive_path: str, time: str) -> DataStreamWriter:
    """Each batch of changes into both journals."""
    return changes.writeStream.foreachBatch(journal_sink(hot_path, archive_path, time))

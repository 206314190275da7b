"""Journals, exports and dated reports on disk."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import suppress
from datetime import date, datetime
from itertools import groupby
from operator import itemgetter
from urllib.parse import unquote
from zlib import crc32

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsebook.functions.timecols import HOT_DAYS
from pulsebook.operators.current import retain
from pulsebook.operators.timeline import beside

DAY = "day"
# Rows of one site that go into one file of an export.
FILE_ROWS = 1_000_000
EXPORT_FORMAT = {"sep": "|", "header": "false", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
# How Spark names the folder of a value: what it escapes, and what stands for null and the empty text.
ESCAPES = {c: f"%{c:02X}" for c in [*range(1, 32), 127, *b"\"#%'*/:=?\\{[]^"]}
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
# What Spark's reader takes for nothing at the ends of a line.
BLANK = bytes(range(33))
# Files or lines that a task hands to Spark at once.
READ_ROWS = 10_000

Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _append_by_day(df: DataFrame, path: str, time: str, run: str) -> None:
    (
        df.withColumn(DAY, F.to_date(time)).withColumn("run", F.lit(run)).hint("rebalance", F.col(DAY))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY, "run").parquet(path)
    )


def journal(changes: DataFrame, hot_path: str, archive_path: str, time: str, run: str) -> None:
    """The same changes into the hot journal and the archive, by day.

    ``run`` names the batch: writing it again replaces what it wrote before, so a
    repeated batch changes nothing. The changes are worked out once, for the archive;
    the hot journal takes what the archive holds of the batch.
    """
    _append_by_day(changes, archive_path, time, run)
    placed = T.StructType([*changes.schema, T.StructField(DAY, T.DateType()), T.StructField("run", T.StringType())])
    landed = changes.sparkSession.read.schema(placed).parquet(archive_path).filter(F.col("run") == run)
    _append_by_day(landed.drop(DAY, "run"), hot_path, time, run)


def read_journal(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


def read_hot(spark: SparkSession, path: str, columns: list[str], time: str, as_of: datetime,
             days: int = HOT_DAYS) -> DataFrame:
    """Hot journal without expired rows; the day bound prunes directories, the time bound is exact."""
    kept = retain(spark.read.parquet(path), time, as_of, days)
    return kept.filter(F.col(DAY) >= F.date_sub(F.lit(as_of.date()), days)).select(*columns)


def expire(spark: SparkSession, path: str, as_of: datetime, days: int = HOT_DAYS) -> list[str]:
    """Delete the day directories that lie wholly before the retention bound."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    bound = as_of.date().toordinal() - days
    gone = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith(f"{DAY}=") and date.fromisoformat(name[len(DAY) + 1 :]).toordinal() < bound:
            fs.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)


def _folder(site: str, value: str | None = None) -> str:
    return f"{site.translate(ESCAPES)}={value.translate(ESCAPES) if value else NULL_FOLDER}"


def _into_folders(folder: str, site: str, run: str) -> Task:
    """Task that writes lines, which come site by site, into one folder per site, and counts its files.

    A file gets its name when it is whole, so a task that runs again puts its files in the place of the first ones.
    """

    def write(batches):
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{run}.c000.csv"
        begun = f".{name}.{task.taskAttemptId()}"
        rows = (row for b in batches for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        files = 0
        for value, lines in groupby(rows, itemgetter(0)):
            at = f"{folder}/{_folder(site, value)}"
            with suppress(FileExistsError):
                os.mkdir(at)
            with open(f"{at}/{begun}", "wb") as out:
                # As with Spark's writer, a row of one null makes no line.
                out.writelines(line[:-2] + b"\n" for _, line in lines if len(line) > 2)
            os.replace(f"{at}/{begun}", f"{at}/{name}")
            files += 1
        yield pa.RecordBatch.from_pydict({"files": [files]})

    return write


def _pairs(rows: list[tuple], name: str, kind: pa.DataType) -> pa.RecordBatch:
    sites, values = zip(*rows, strict=True) if rows else ((), ())
    return pa.RecordBatch.from_pydict({"site": pa.array(sites, pa.string()), name: pa.array(values, kind)})


def _files(folder: str, site: str, share: int) -> Task:
    """Task that lists the files of its share of the sites' folders."""
    head = _folder(site).removesuffix(NULL_FOLDER)

    def listed(batches):
        files = []
        for b in batches:
            for mine in b.column(0).to_pylist():
                with os.scandir(folder) as entries:
                    names = [e.name for e in entries if e.name.startswith(head)]
                for name in names:
                    if crc32(os.fsencode(name)) % share == mine:
                        value = name.removeprefix(head)
                        value = None if value == NULL_FOLDER else unquote(value)
                        found = [f"{folder}/{name}/{f}" for f in os.listdir(f"{folder}/{name}") if not f.startswith((".", "_"))]
                        files.extend((value, f) for f in found)
                    if len(files) >= READ_ROWS:
                        yield _pairs(files, "file", pa.string())
                        files = []
        yield _pairs(files, "file", pa.string())

    return listed


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of files, as Spark's reader parts them: at any line end, without the blank ones."""
    lines = []
    for b in batches:
        for site, file in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            with open(file, "rb") as found:
                for text in found:
                    lines.extend((site, line) for line in text.splitlines() if line.strip(BLANK))
                    if len(lines) >= READ_ROWS:
                        yield _pairs(lines, "line", pa.binary())
                        lines = []
    yield _pairs(lines, "line", pa.binary())


def _directory(spark: SparkSession, path: str) -> str | None:
    """The path as a plain directory that tasks can open by themselves, if it is one."""
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = name.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(name).toUri().getPath() if fs.getUri().getScheme() == "file" else None


def _export_locally(dealt: DataFrame, path: str, site: str) -> None:
    """An export into a plain directory.

    Hadoop's local file system starts a process for each permission it sets, five for a file in a folder of its own, and
    the commit moves folder by folder on the driver. Here tasks write the files themselves, below a hidden folder that
    takes the place of ``path`` when all are there. Spark makes the lines, and by an empty export the hidden folder.
    """
    spark, run = dealt.sparkSession, uuid.uuid4().hex
    name = spark._jvm.org.apache.hadoop.fs.Path
    fs = name(path).getFileSystem(spark._jsc.hadoopConfiguration())
    target = fs.makeQualified(name(path))
    hidden = name(target.getParent(), f".{target.getName()}-{run}")
    value = F.nullif(F.col(site).cast("string"), F.lit(""))
    # A row of one null has no text, so a last column goes with each row; the tasks take it off.
    line = F.to_csv(F.struct(*dealt.drop(site).columns, F.lit(1).alias("_end")), EXPORT_FORMAT).cast("binary")
    try:
        dealt.limit(0).write.partitionBy(site).options(**EXPORT_FORMAT).csv(hidden.toString())
        lines = dealt.select(value.alias("site"), line.alias("line")).sortWithinPartitions("site")
        lines.mapInArrow(_into_folders(hidden.toUri().getPath(), site, run), "files long").agg(F.sum("files")).collect()
    except BaseException:
        fs.delete(hidden, True)
        raise
    fs.delete(target, True)
    if not fs.rename(hidden, target):
        raise OSError(f"{hidden.toString()} could not be moved to {target.toString()}")


def export_daily(df: DataFrame, path: str, site: str, file_rows: int = FILE_ROWS) -> None:
    """Headerless ``|``-separated series, one directory per site, all sites in one job.

    What an export takes is files, not bytes, so the sites are dealt over as many tasks as the session has shuffle
    partitions, which are not joined where they are small. A small site is one file; one of more than ``file_rows``
    rows is dealt over several tasks, by its rows.
    """
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # At most one row per ``file_rows`` rows.
    busy = df.groupBy(site).agg(F.ceil(F.count("*") / file_rows).alias("_files")).filter("_files > 1")
    dealt = beside(df, busy, [site]).withColumn("_file", F.coalesce(F.pmod(F.xxhash64(*df.columns), "_files"), F.lit(0)))
    dealt = dealt.repartition(tasks, site, "_file").select(*df.columns)
    if _directory(spark, path) and spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static":
        _export_locally(dealt, path, site)
    else:
        dealt.write.mode("overwrite").partitionBy(site).options(**EXPORT_FORMAT).csv(path)


def read_export(spark: SparkSession, path: str, schema: str, site: str) -> DataFrame:
    """The rows of an export, with their site as text in the last column; ``schema`` has the others.

    Spark's reader would hold a partition per site on the driver, and resolves their values in time that grows with
    their square; it also takes milliseconds to open a file. In a plain directory tasks list the folders and read the files.
    """
    folder = _directory(spark, path)
    if folder is None:
        return spark.read.schema(f"{schema}, {site} string").options(**EXPORT_FORMAT).csv(path)
    share = spark.sparkContext.defaultParallelism
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = spark.range(0, share, 1, share).mapInArrow(_files(folder, site, share), "site string, file string")
    lines = files.repartition(tasks, "file").mapInArrow(_lines, "site string, line binary")
    row = F.from_csv(F.col("line").cast("string"), schema, EXPORT_FORMAT)
    return lines.select(row.alias("row"), "site").select("row.*", F.col("site").alias(site))


def write_report(df: DataFrame, path: str, report_date: date) -> None:
    """One output per day; a rerun replaces that day only."""
    (
        df.withColumn("report_date", F.lit(report_date)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("report_date").parquet(path)
    )


def report_dates(spark: SparkSession, as_of: date, back: int = 5) -> DataFrame:
    """The days for which a report is offered: that day and some before."""
    return spark.range(1).select(
        F.explode(F.sequence(F.date_sub(F.lit(as_of), back), F.lit(as_of))).alias("report_date")
    )

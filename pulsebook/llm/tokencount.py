"""Token counts of flat token files by separator scan.

A flat token file holds ids of a fixed width one after the other, each document's followed by an end-of-document id,
and no index. It is read in blocks. In each block a vectorised search finds the end ids; a document's length is the
distance between two of them. What crosses blocks is stitched by a prefix scan over one row per block: how many
ends came before, and where the last of them was.

``write_flat`` makes such files from documents with Spark's text writer: a document's ids are the line and the end id is
the line separator, so the files commit like any other table's and live in any store that Spark writes to.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pulsebook.llm.common import query, stage, table
from pulsebook.llm.packing import encoder, public_files
from pulsebook.session import work_folder

# Big-endian 16-bit ids. The end id lies beyond the vocabulary, and its two bytes are the UTF-8 form of a character,
# as the separator of a text file has to be.
KIND, END = ">u2", 50304
BLOCK_BYTES = 1 << 20
FILE_ROWS = 8192
# Texts up to so many bytes go into files of at most so many documents, longer ones into files of their own: an id takes
# two bytes and stands for one byte of text at least, so files stay below 128 MB but for a single text beyond that.
SIZES = ((1 << 13, FILE_ROWS), (1 << 19, 128), (None, 1))


def _encoded(kind: str, files: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*files)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                texts = batch.column("text").slice(start, 500).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([encode(t or "").astype(kind).tobytes() for t in texts], pa.binary())], names=["ids"]
                )

    return run


def write_flat(df: DataFrame, path: str, text: str = "text", kind: str = KIND, end: int = END, file_rows: int = FILE_ROWS,
               files: tuple[str, ...] | None = None) -> None:
    """Flat token files of the documents, null texts as empty ones, in the order of the rows."""
    separator = np.array([end], kind).tobytes().decode()
    ids = df.select(F.col(text).alias("text")).mapInArrow(_encoded(kind, files or public_files()), "ids binary")
    ids.select(F.col("ids").cast("string").alias("value")).write.option("lineSep", separator).option(
        "maxRecordsPerFile", file_rows
    ).option("compression", "none").text(path)


def _ends(kind: str, end: int, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = np.dtype(kind).itemsize
        for batch in batches:
            found, last = [], []
            for number, data in zip(batch.column("block").to_pylist(), batch.column("data")):
                at = np.flatnonzero(np.frombuffer(data.as_buffer(), kind) == end) + number * (block_bytes // width)
                found.append(at.astype(np.int64))
                last.append(int(at[-1]) if len(at) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("block"), pa.array(found, pa.list_(pa.int64())), pa.array(last, pa.int64())],
                names=["file", "block", "ends", "last"],
            )

    return run


def scan(spark: SparkSession, path: str, kind: str = KIND, end: int = END, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``file``, ``number`` (of the document in its file, from 0), ``start``, ``n_tokens``, from flat token files.

    The end id is not counted. Ids after a file's last end id are no document. Files are in any store that Spark reads;
    one is read by one task and must be below 2 GiB, as ``counted`` makes them.
    """
    width = np.dtype(kind).itemsize
    if block_bytes % width:
        raise ValueError("a block holds whole ids")
    files = spark.read.format("binaryFile").load(path).select("path", "length", "content").where("length > 0")
    count = F.ceil(F.col("length") / block_bytes).cast("int")
    blocks = files.select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "content", F.explode(F.sequence(F.lit(0), count - 1)).alias("block")
    ).select("file", "block", F.substring("content", F.col("block") * block_bytes + 1, F.lit(block_bytes)).alias("data"))
    ends = stage(blocks.mapInArrow(_ends(kind, end, block_bytes), "file string, block int, ends array<long>, last long"), "ends")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # One row per block.
    carried = ends.select("file", "block", F.size("ends").alias("n"), "last").select(
        "file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
        F.coalesce(F.last("last", ignorenulls=True).over(before) + 1, F.lit(0)).alias("start"),
    )
    starts = F.concat(F.array("start"), F.transform(F.slice("ends", 1, F.size("ends") - 1), lambda e: e + 1))
    return (
        ends.where(F.size("ends") > 0).join(carried, ["file", "block"])
        .select("file", "first", F.posexplode(F.arrays_zip(starts.alias("start"), F.col("ends").alias("end"))).alias("i", "d"))
        .select("file", (F.col("first") + F.col("i")).alias("number"), F.col("d.start").alias("start"), (F.col("d.end") - F.col("d.start")).alias("n_tokens"))
    )


def counted(df: DataFrame, key: str = "doc_id", text: str = "text", file_rows: int = FILE_ROWS) -> DataFrame:
    """``key`` and ``n_tokens`` of each row, by writing flat token files and scanning them.

    Flat files hold no keys, so a document is known by its file and its number there. ``df`` must be read from files
    without a shuffle, which deals rows the same way every time; a count that finds no row, or a row no count, is an
    error. Null and empty texts have 0 tokens; very long texts have files of their own (``SIZES``), which bounds a file's
    bytes whatever the texts are; repeated rows and null keys are rows of their own; an empty table gives an empty result;
    other columns are ignored, whatever their names.
    """
    size, least, parts = F.coalesce(F.octet_length(F.col(text)), F.lit(0)), -1, []
    for most, rows in SIZES:
        within = size > least if most is None else size.between(least + 1, most)
        parts.append(_counted(df.where(within).select(F.col(key).alias("key"), F.col(text).alias("text")), min(rows, file_rows)))
        least = most
    return reduce(DataFrame.unionAll, parts)


def _counted(df: DataFrame, file_rows: int) -> DataFrame:
    spark = df.sparkSession
    path = work_folder(spark, "flat-tokens")
    write_flat(df, path, file_rows=file_rows)
    # Rows of a task are numbered as the writer meets them; every ``file_rows`` rows it begins a new file.
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = df.select("key", F.spark_partition_id().alias("part"), number.alias("number"), F.lit(True).alias("row"))
    name = F.regexp_extract("file", r"^part-(\d+)-.*-c(\d+)", 1), F.regexp_extract("file", r"^part-(\d+)-.*-c(\d+)", 2)
    found = scan(spark, path).select(
        name[0].cast("int").alias("part"), (F.col("number") + name[1].cast("long") * file_rows).alias("number"), "n_tokens"
    )
    both = rows.join(found, ["part", "number"], "full_outer")
    lost = F.col("row").isNull() | F.col("n_tokens").isNull()
    return both.select("key", F.when(lost, F.raise_error(F.lit("rows and token files do not agree")).cast("long")).otherwise(F.col("n_tokens")).alias("n_tokens"))


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's number of tokens."""
    return counted(table(spark, folder, "documents")).withColumnRenamed("key", "doc_id")

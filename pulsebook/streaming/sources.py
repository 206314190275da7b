"""Streams of landed polls and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from pulsebook.sources.logs import with_log_place

POLL_SECONDS = 60


def stream_table(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None,
                 name: str | None = None) -> DataFrame:
    """Files landing in a folder as a stream; ``name`` picks files by pattern."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if name:
        reader = reader.option("pathGlobFilter", name)
    return reader.parquet(path)


def stream_cell_log(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """New controller log files as lines; nothing already read is read again.

    ``block`` says where a line comes from; :func:`stream_cell_events` makes the line
    order of it within a batch, which a stream itself cannot do.

    The collector lands what is new as a new file ``<controller>/<yyMMdd>.log`` or, for
    later parts of a day, ``<controller>/<part>-<yyMMdd>.log``.
    """
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.text(path).select(
        "value", F.col("_metadata.file_path").alias("path"),
        F.struct(
            F.unix_micros(F.col("_metadata.file_modification_time")).alias("landed"),
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        ).alias("block"),
    )
    return with_log_place(lines, "path").select("controller", "log_date", "block", F.col("value").alias("line"))


def run_stream(writer: DataStreamWriter, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Start a query: over what is there, or once a minute for ever."""
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{POLL_SECONDS} seconds")
    query = writer.start()
    if once:
        query.awaitTermination()
    return query

"""Device registries from delimited text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsebook.functions.values import is_comment, nth_field

REGISTRY_COLUMNS = ["ip", "name", "description", "visio_name"]


def parse_registry(lines: DataFrame, line: str = "value", columns: list[str] | None = None) -> DataFrame:
    """Fields of ``|``-separated lines; comments skipped, missing fields null, quotes kept."""
    columns = columns or REGISTRY_COLUMNS
    kept = lines.filter(~is_comment(line) & (F.trim(line) != ""))
    return kept.select(*[nth_field(line, "|", i + 1).alias(c) for i, c in enumerate(columns)])


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return parse_registry(spark.read.text(path))


def parse_cell_registry(lines: DataFrame, line: str = "value", folder: str = "folder") -> DataFrame:
    """Station check-list: cell and do/not by TAB, the controller from the folder name."""
    return lines.filter(F.trim(line) != "").select(
        F.regexp_extract(folder, r"([^/]+)/[^/]*$", 1).alias("controller"),
        nth_field(line, "\t", 1).try_cast("int").alias("cell"),
        F.trim(nth_field(line, "\t", 2)).alias("check"),
    )


def read_cell_registry(spark: SparkSession, path: str) -> DataFrame:
    return parse_cell_registry(spark.read.text(path).withColumn("folder", F.col("_metadata.file_path")))


def scan(spark: SparkSession, folder: str, name: str, schema: str | None = None) -> DataFrame:
    """A table of the given folder; with a schema no footer is read to find it out."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")

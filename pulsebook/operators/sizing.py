"""How many rows of one key a task should hold."""

from __future__ import annotations

from pyspark.sql import SparkSession

SPLIT_ROWS = "pulsebook.split.rows"
SPLIT_ROWS_DEFAULT = 4_000_000


def split_rows(spark: SparkSession) -> int:
    """Rows of one key that a task may hold with ease."""
    return int(spark.conf.get(SPLIT_ROWS, str(SPLIT_ROWS_DEFAULT)))


def rows_per_cut(spark: SparkSession) -> int:
    """Cuts come by chance, so slices differ: a quarter of that on average."""
    return max(2, split_rows(spark) // 4)

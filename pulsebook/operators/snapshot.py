"""State at fixed moments."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsebook.functions.timecols import ntz
from pulsebook.operators.timeline import passed

# Marks that a reading is compared with at a time.
BLOCK = 512


def numbered_marks(df: DataFrame, marks: list[datetime] | DataFrame) -> DataFrame:
    """Marks in order, each once: ``mark``, ``_number`` from 0."""
    if isinstance(marks, DataFrame):
        table = marks.select(F.col(marks.columns[0]).alias("mark"))
    else:
        table = df.sparkSession.createDataFrame([(m,) for m in marks], "mark timestamp_ntz")
    # One row per mark.
    number = F.row_number().over(Window.orderBy("mark")) - 1
    return table.dropna().distinct().select("mark", number.alias("_number"))


def snapshot_asof(df: DataFrame, marks: list[datetime] | DataFrame, key, time: str, values: list[str],
                  tie: str | None = None) -> DataFrame:
    """Per key and mark the last reading at or before the mark; ``marks`` may be a frame of one column.

    Marks are numbered in order, and a reading counts for the first one at or after it: its block by the blocks' last
    marks, its place by those of the block. Readings are aggregated to one row per key and mark before the shuffle.
    Marks without a reading of their own take the one before: each aggregated row is repeated for the numbers up to
    that of the next such row. Joins are equalities with the marks; neither plan nor rows grow with them.
    """
    keys = [key] if isinstance(key, str) else list(key)
    position = F.struct(time, tie) if tie else F.col(time)
    row = F.struct(F.col(time).alias("read_at"), *values)
    rows = df.filter(F.col(time).isNotNull()).select(*keys, F.col(time).alias("_at"), position.alias("_position"), row.alias("_row"))
    few = not isinstance(marks, DataFrame) and len(marks) <= BLOCK
    if few:
        # Short lists need no table.
        listed = F.array(*[ntz(m) for m in sorted(set(marks))]).cast("array<timestamp_ntz>")
        placed = rows.withColumn("_marks", listed).withColumn("_mark", F.expr(passed("_marks", "{} < _at")))
        placed, total = placed.filter(F.col("_mark") < F.size("_marks")), F.lit(len(set(marks)))
    else:
        numbered = numbered_marks(df, marks)
        blocks = numbered.groupBy(F.floor(F.col("_number") / BLOCK).cast("int").alias("_block")).agg(
            F.sort_array(F.collect_list("mark")).alias("_marks")
        )
        ends = blocks.agg(F.sort_array(F.collect_list(F.array_max("_marks"))).alias("all")).scalar()
        blocked = rows.withColumn("_ends", ends).withColumn("_block", F.expr(passed("_ends", "{} < _at"))).drop("_ends")
        placed = blocked.join(blocks, "_block").withColumn("_mark", F.expr(f"_block * {BLOCK} + {passed('_marks', '{} < _at')}"))
        total = numbered.agg(F.count("*")).scalar()
    per_mark = placed.groupBy(*keys, "_mark").agg(F.max_by("_row", "_position").alias("_r"))
    until = F.lead("_mark").over(Window.partitionBy(*keys).orderBy("_mark"))
    held = per_mark.withColumn("_until", until).withColumn("_total", total)
    numbers = F.sequence(F.col("_mark"), (F.coalesce("_until", "_total") - 1).cast("int"))
    repeated = held.select(*keys, "_r", F.explode(numbers).alias("_number"))
    marked = repeated.withColumn("mark", F.get(listed, F.col("_number"))) if few else repeated.join(numbered, "_number")
    return marked.select(*keys, "mark", "_r.read_at", *[F.col(f"_r.{v}").alias(v) for v in values])


def daily_marks(days: list[datetime], hours: tuple[int, ...] = (0, 3, 6)) -> list[datetime]:
    return [d.replace(hour=h) for d in days for h in hours]

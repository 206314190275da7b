"""Running-hours figures from a device's hours counter."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsebook.functions.timecols import DAY_US, elapsed_us


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def first_seen(df: DataFrame, key, counter: str, time: str) -> DataFrame:
    """When each counter value was first seen."""
    return df.groupBy(*_keys(key), counter).agg(F.min(time).alias(time))


def hours_per_day(journal: DataFrame, key, counter: str, time: str) -> DataFrame:
    """Average running hours per day at each hour reached: 1 / days between two hours.

    Each hour is listed under itself and under the next one and the two meet in a group
    of (key, counter), so a busy device spreads over its counter values and the journal
    is read once. Hours without a key or number, or without the hour before, give no row.
    A figure that does not fit numeric(3,2), or a zero duration, gives null.
    """
    keys = _keys(key)
    seen = first_seen(journal, keys, counter, time).dropna(subset=[*keys, counter])
    hour = F.col(counter).cast("bigint")
    listed = seen.select(*keys, time, F.inline(F.array(
        F.struct(hour.alias("last_hour"), F.lit(True).alias("_own")),
        F.struct(F.try_add(hour, F.lit(1)).alias("last_hour"), F.lit(False).alias("_own")),
    )))
    own, at = F.col("_own"), F.col(time)
    met = listed.groupBy(*keys, "last_hour").agg(
        F.max(F.when(own, at)).alias("last_time"), F.max(F.when(~own, at)).alias("before_time"),
        (F.count(F.lit(1)) == 2).alias("_both"),
    )
    return met.filter("_both").select(
        *keys, F.col("last_hour").try_cast(journal.schema[counter].dataType).alias("last_hour"), "last_time", "before_time",
        _per_day("before_time", "last_time").alias("average"),
    )


def _per_day(before: str, last: str) -> Column:
    return F.try_divide(F.lit(1.0), elapsed_us(before, last) / F.lit(float(DAY_US))).try_cast("decimal(3,2)")


def latest_with_average(marked: DataFrame, key, counter: str, time: str, tie: str, changed: str = "changed") -> DataFrame:
    """Each key's last row, with its hour's ``average`` of ``hours_per_day``; null where that gives no row.

    ``marked`` are all rows with whether they are in the change journal (``marked_changes``), so that the rows are
    gone through once: the last row and the first change of every (key, counter), the hours that meet as in
    ``hours_per_day``, and of these the last of the key.
    """
    keys = _keys(key)
    rest = [c for c in marked.columns if c not in (*keys, changed)]
    hours = marked.groupBy(*keys, F.col(counter).cast("bigint").alias("_hour")).agg(
        F.min(F.when(F.col(changed), F.col(time))).alias("_at"), F.max_by(F.struct(*rest), F.struct(time, tie)).alias("_row")
    )
    listed = hours.select(*keys, F.inline(F.array(
        F.struct("_hour", F.col("_at").alias("_last"), F.lit(None).cast(hours.schema["_at"].dataType).alias("_before"), "_row"),
        F.struct(
            F.try_add("_hour", F.lit(1)).alias("_hour"), F.lit(None).cast(hours.schema["_at"].dataType).alias("_last"),
            F.col("_at").alias("_before"), F.lit(None).cast(hours.schema["_row"].dataType).alias("_row"),
        ),
    )))
    met = listed.groupBy(*keys, "_hour").agg(
        F.max("_last").alias("_last"), F.max("_before").alias("_before"), F.first("_row", ignorenulls=True).alias("_row")
    )
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*keys, "_hour")])
    now = met.filter("_row IS NOT NULL").withColumn("average", F.when(known, _per_day("_before", "_last")))
    last = now.groupBy(*keys).agg(F.max_by(F.struct("_row", "average"), F.struct(f"_row.{time}", f"_row.{tie}")).alias("_now"))
    return last.select(*keys, "_now._row.*", "_now.average")


def archived_hours(transitions: DataFrame, averages: DataFrame, key, counter: str) -> DataFrame:
    """Hour transitions with the average of that hour, times 100 as a small integer."""
    keys = _keys(key)
    a = averages.select(
        *keys, F.col("last_hour").alias(counter), F.round(F.col("average") * 100).cast("smallint").alias("average")
    )
    return transitions.join(a, [*keys, counter], "left")

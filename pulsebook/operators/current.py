"""Current state, journals and retention."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsebook.functions.timecols import HOT_DAYS, recent
from pulsebook.operators.timeline import Timeline


def _list(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def latest(df: DataFrame, key, time: str, tie: str | None = None) -> DataFrame:
    """Last row per key. Aggregated before the shuffle, so a heavy key costs one row per task."""
    keys = _list(key)
    rest = [c for c in df.columns if c not in keys]
    position = F.struct(time, tie) if tie else F.col(time)
    return (
        df.groupBy(*keys).agg(F.max_by(F.struct(*rest), position).alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
        .select(*df.columns)
    )


def heartbeat(changes: DataFrame, current: DataFrame) -> DataFrame:
    """Hot journal with the current rows added under their own time."""
    return changes.unionByName(current.select(*changes.columns))


def retain(df: DataFrame, time: str, as_of: datetime, days: int = HOT_DAYS) -> DataFrame:
    """Rows not older than ``days``; older ones are dropped, exactly ``days`` is kept."""
    return df.filter(recent(time, as_of, days))


def with_site(frames: dict[str, DataFrame], column: str = "site") -> DataFrame:
    """The same table from several sites as one, told apart by a column."""
    tagged = [df.withColumn(column, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def attach_metric(transitions: DataFrame, metric: DataFrame, on) -> DataFrame:
    """Transition rows with the metric worked out for them; rows without one stay."""
    return transitions.join(metric, _list(on), "left")


def apply_flags(registry: DataFrame, commands: DataFrame, key, time: str, flag: str = "check",
                tie: str | None = None) -> DataFrame:
    """Registry with each key's last commanded flag in place of the stored one."""
    keys = _list(key)
    last = latest(commands.select(*keys, time, *([tie] if tie else []), flag), keys, time, tie)
    new = last.select(*keys, F.col(flag).alias("_new"))
    return registry.join(new, keys, "left").withColumn(flag, F.coalesce("_new", flag)).drop("_new")


def known_commands(df: DataFrame, command: str, known: list[str]) -> DataFrame:
    return df.filter(F.col(command).isin(*known))


def complete_rows(df: DataFrame, needed: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with every needed value, and the others for quarantine."""
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in needed])
    return df.filter(~bad), df.filter(bad)


def monitored(df: DataFrame, registry: DataFrame, key, flag: str = "check") -> DataFrame:
    """Rows of keys the registry does not exclude."""
    keep = registry.filter(~F.coalesce(F.col(flag) == "not", F.lit(False)))
    return df.join(keep.select(*_list(key)), _list(key), "left_semi")


def registered(df: DataFrame, registry: DataFrame, key) -> DataFrame:
    """Rows whose key is in the registry: what a cascading delete leaves."""
    return df.join(registry.select(*_list(key)), _list(key), "left_semi")


def renamed(df: DataFrame, renames: DataFrame, key: str, old: str = "old", new: str = "new") -> DataFrame:
    """Keys replaced by a rename map: what a cascading update leaves."""
    m = renames.select(F.col(old).alias(key), F.col(new).alias("_new"))
    return df.join(m, key, "left").withColumn(key, F.coalesce("_new", key)).drop("_new").select(*df.columns)


def probe_result(attempts: DataFrame, key, poll: str, received: str = "received") -> DataFrame:
    """A poll succeeds when any of its attempts does."""
    return attempts.groupBy(*_list(key), poll).agg(F.bool_or(received).alias("state"))


def last_n(df: DataFrame, key, order: str, n: int, tie: str | None = None) -> DataFrame:
    """The n newest rows per key, numbered from the newest; cut before and after the shuffle."""
    by = [F.col(order).desc()] + ([F.col(tie).desc()] if tie else [])
    w = Window.partitionBy(*_list(key)).orderBy(*by)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def first_n_overall(df: DataFrame, order: list, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def daily_counts(events: DataFrame, key, time: str) -> DataFrame:
    return events.groupBy(*_list(key), F.to_date(time).alias("day")).agg(F.count(F.lit(1)).alias("events"))


def failing_parts(status: DataFrame, key, size: int, cell: str = "cell", state: str = "status") -> DataFrame:
    """The failing cells of each key as lines of at most ``size`` cells, numbered from 0, in cell order.

    Cells are counted along the cut key, so neither a task nor a line holds all cells of a key.
    """
    off = status.filter(F.col(state) == "off").select(*_list(key), cell, state)
    counted = Timeline.of(off, key, cell).running(_n=F.lit(1)).rows()
    part = F.concat(F.lit("БС№"), F.col(cell).cast("string"), F.lit("="), F.col(state), F.lit("."))
    return (
        counted.groupBy(*_list(key), F.floor((F.col("_n") - 1) / size).alias("part"))
        .agg(F.sort_array(F.collect_list(F.struct(F.col(cell), part.alias("text")))).alias("_p"))
        .select(*_list(key), "part", F.array_join("_p.text", " ").alias("failing"))
    )


def failing_list(status: DataFrame, key, cell: str = "cell", state: str = "status") -> DataFrame:
    """The failing cells of each key as one line of text, in cell order.

    ``status`` is current state, one row per registered cell; the line itself is the
    feature, so it holds all of them.
    """
    part = F.concat(F.lit("БС№"), F.col(cell).cast("string"), F.lit("="), F.col(state), F.lit("."))
    return (
        status.filter(F.col(state) == "off").groupBy(*_list(key))
        .agg(F.sort_array(F.collect_list(F.struct(F.col(cell), part.alias("part")))).alias("_p"))
        .select(*_list(key), F.array_join("_p.part", " ").alias("failing"))
    )

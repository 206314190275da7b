"""Change journals: what differs from the key's previous reading."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsebook.functions.timecols import elapsed_us
from pulsebook.functions.values import any_differs, differs, within
from pulsebook.operators.timeline import Timeline

PREV = "_prev"


def _previous(df: DataFrame | Timeline, key, time: str, tie: str | None, columns: list[str]) -> DataFrame:
    return Timeline.of(df, key, time, tie).previous(PREV, *columns).rows()


def changes(
    df: DataFrame | Timeline, key, time: str, watched: list[str], tie: str | None = None, null_safe: bool = True
) -> DataFrame:
    """Rows in which a watched column differs from the key's previous row.

    A key's first row never counts. With ``null_safe=False`` a null on either side
    does not count as a difference. A timeline of that key and order goes on with its slices.
    """
    return _previous(df, key, time, tie, watched).filter(_moved(watched, null_safe)).drop(PREV)


def _moved(watched: list[str], null_safe: bool) -> Column:
    pairs = [(F.col(c), F.col(f"{PREV}.{c}")) for c in watched]
    if null_safe:
        moved = reduce(lambda a, b: a | b, [differs(a, b) for a, b in pairs])
    else:
        moved = any_differs(pairs)
    return F.col(PREV).isNotNull() & moved


def marked_changes(
    df: DataFrame | Timeline, key, time: str, watched: list[str], tie: str | None = None, null_safe: bool = True, name: str = "changed"
) -> DataFrame:
    """All rows, with whether ``changes`` would keep them."""
    return _previous(df, key, time, tie, watched).withColumn(name, F.coalesce(_moved(watched, null_safe), F.lit(False))).drop(PREV)


def changes_within(
    df: DataFrame, key, time: str, value: str, limit: float = 5, exempt: Column | None = None,
    tie: str | None = None,
) -> DataFrame:
    """Changes smaller than ``limit`` against the raw predecessor.

    Spikes are kept as predecessors, so the way back from one is rejected too.
    Rows matching ``exempt`` skip the limit.
    """
    # Worked out on the given frame, whose own columns the condition may name.
    marked = df.withColumn("_free", F.lit(False) if exempt is None else exempt)
    out = _previous(marked, key, time, tie, [value])
    old = F.col(f"{PREV}.{value}")
    small = within(value, old, limit) | F.col("_free")
    return out.filter(F.col(PREV).isNotNull() & differs(value, old) & small).drop(PREV, "_free")


def carry_forward(df: DataFrame, key, time: str, value: str, tie: str | None = None) -> DataFrame:
    """Nulls replaced by the key's previous non-null value."""
    return Timeline.of(df, key, time, tie).carry(**{value: F.col(value)}).rows()


def outages(df: DataFrame, key, time: str, up: str, tie: str | None = None) -> DataFrame:
    """One row per outage: when it was lost, when it came back, how long it took.

    A key counts as up before its first reading; an open outage has no end.
    """
    keys = [key] if isinstance(key, str) else list(key)
    line = Timeline.of(df, keys, time, tie).previous(PREV, up)
    edges = line.filter(F.col(up) != F.coalesce(F.col(f"{PREV}.{up}"), F.lit(True)))
    paired = edges.following("_next", time).rows()
    return paired.filter(~F.col(up)).select(
        *keys,
        F.col(time).alias("lost"),
        F.col(f"_next.{time}").alias("restored"),
        elapsed_us(time, f"_next.{time}").alias("outage_us"),
    )


def silences(df: DataFrame, key, time: str, gap_seconds: int, tie: str | None = None) -> DataFrame:
    """Stretches longer than the gap in which a key sent nothing."""
    keys = [key] if isinstance(key, str) else list(key)
    out = Timeline.of(df, keys, time, tie).following("_next", time).rows()
    length = elapsed_us(time, f"_next.{time}")
    return out.filter(length > gap_seconds * 1_000_000).select(
        *keys, F.col(time).alias("silent_from"), F.col(f"_next.{time}").alias("silent_to"),
        length.alias("silent_us"),
    )


def snapshot_diff(before: DataFrame, after: DataFrame, key, state: str, initial) -> DataFrame:
    """Keys whose state in ``after`` is not the remembered one; unknown keys start at ``initial``."""
    keys = [key] if isinstance(key, str) else list(key)
    old = before.select(*keys, F.col(state).alias("old_state"))
    joined = after.join(old, keys, "left").withColumn("old_state", F.coalesce("old_state", F.lit(initial)))
    return joined.filter(differs(state, "old_state")).select(
        *keys, "old_state", F.col(state).alias("new_state")
    )


def state_changes(df: DataFrame, key, time: str, state: str, initial, tie: str | None = None) -> DataFrame:
    """Like :func:`changes`, with a remembered state before the first row."""
    out = _previous(df, key, time, tie, [state])
    return out.filter(differs(state, F.coalesce(F.col(f"{PREV}.{state}"), F.lit(initial)))).drop(PREV)

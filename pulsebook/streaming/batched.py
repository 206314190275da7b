"""Streams that run the batch operators batch by batch.

What an operator must remember fits one row per key: the key's last row, its last
accepted row, or its last control state. Each batch puts these remembered rows in
front of the new ones and runs the batch operator over both, so the answers are the
batch operator's and a key that fills a third of a batch is cut into slices by it.
The remembered rows live in a :class:`CurrentTable`, of which a batch writes the
buckets of its own keys. An operator takes its rows several times over, so remembered
and new rows are written before it runs.

With ``delay`` seconds rows may come that late: they wait until nothing in time can
come before them (:class:`Waiting`), and rows later than that are refused. Without it
rows not after the last one taken for their key are late and are refused. Refused rows
go to the late sink where one is given. A batch is evaluated once and held while it is
used.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from pulsebook.functions.bands import OFF, ON
from pulsebook.functions.timecols import elapsed_us
from pulsebook.operators.cells import cell_events
from pulsebook.operators.changes import changes, changes_within
from pulsebook.operators.current import latest
from pulsebook.operators.escalation import escalate_watch, final_states
from pulsebook.operators.folds import accept_within
from pulsebook.operators.latch import AUTO_OFF, AUTO_ON, latch_with_commands
from pulsebook.operators.timeline import Timeline
from pulsebook.operators.watch import LINE, first_failing_steps, seen_events
from pulsebook.streaming.tables import CurrentTable, Records
from pulsebook.streaming.waiting import Waiting, micros

Sink = Callable[[DataFrame, int], None]
SEED = "_seed"
POLL = "is_poll"


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


@contextmanager
def held(*frames: DataFrame):
    """Frames that are evaluated once while they are used."""
    kept = [f.persist() for f in frames]
    try:
        yield kept[0] if len(kept) == 1 else kept
    finally:
        for f in kept:
            f.unpersist()


@contextmanager
def written(frame: DataFrame, path: str):
    """A frame that is worked out once, into a folder that is there while it is used.

    Unlike a held frame it cuts the plan: an operator that takes it several times reads rows, whatever they were made of.
    """
    spark = frame.sparkSession
    frame.write.mode("overwrite").parquet(path)
    try:
        yield spark.read.schema(frame.schema).parquet(path)
    finally:
        Records(spark, path).delete(path)


def not_late(batch: DataFrame, last: DataFrame, key, time: str, tie: str, late: bool = False) -> DataFrame:
    """Rows after the last one taken for their key, or with ``late`` the others."""
    seen = last.select(*_keys(key), F.struct(F.col(time), F.col(tie)).alias("_last"))
    fresh = F.col("_last").isNull() | (F.struct(time, tie) > F.col("_last"))
    return batch.join(seen, _keys(key), "left").filter(~fresh if late else fresh).drop("_last")


def _run(stream: DataFrame, key, time: str, tie: str, path: str, sink: Sink,
         operator: Callable[[DataFrame], DataFrame], seeds: Callable[[DataFrame], DataFrame],
         remember: Callable[[DataFrame, DataFrame], DataFrame], late: Sink | None = None,
         delay: float | None = None) -> DataStreamWriter:
    """``seeds`` makes operator input of what is remembered; ``remember`` takes rows and output."""

    def write(batch: DataFrame, number: int) -> None:
        table = CurrentTable(batch.sparkSession, f"{path}/last", key)
        last = table.read(before=number)
        with held(batch) as arrived:
            if delay is not None:
                new, refused, _ = Waiting(batch.sparkSession, f"{path}/waiting", time, delay).release(arrived, number)
            elif last is None:
                new, refused = arrived, None
            else:
                new = not_late(arrived, last, key, time, tie)
                refused = not_late(arrived, last, key, time, tie, late=True)
            if late is not None and refused is not None:
                late(refused, number)
            rows = new.withColumn(SEED, F.lit(False))
            if last is not None:
                # Only keys with new rows have to go on.
                mine = last.join(new.select(*_keys(key)).distinct(), _keys(key), "left_semi")
                rows = rows.unionByName(seeds(mine).select(*new.columns).withColumn(SEED, F.lit(True)))
            with written(rows, f"{path}/taken") as taken, held(operator(taken)) as out:
                sink(out.filter(~F.col(SEED)).drop(SEED), number)
                with held(remember(taken, out)) as kept:
                    table.merge(kept, number, lambda old, now: latest(old.unionByName(now.select(*old.columns)), key, time, tie))

    return stream.writeStream.foreachBatch(write)


def stream_changes(stream: DataFrame, key, time: str, watched: list[str], tie: str, path: str, sink: Sink,
                   null_safe: bool = True, late: Sink | None = None, delay: float | None = None) -> DataStreamWriter:
    """Changes against the key's previous row, across batches."""
    return _run(
        stream, key, time, tie, path, sink,
        operator=lambda rows: changes(rows, key, time, watched, tie, null_safe),
        seeds=lambda last: last,
        remember=lambda rows, out: latest(rows.drop(SEED), key, time, tie), late=late, delay=delay,
    )


def stream_changes_within(stream: DataFrame, key, time: str, value: str, tie: str, path: str, sink: Sink,
                          limit: float = 5, exempt: Column | None = None, late: Sink | None = None,
                          delay: float | None = None) -> DataStreamWriter:
    """Changes below the limit against the raw predecessor, across batches.

    The condition is worked out on the stream, whose own columns it may name.
    """
    free = "_exempt"
    return _run(
        stream.withColumn(free, F.lit(False) if exempt is None else exempt), key, time, tie, path, sink,
        operator=lambda rows: changes_within(rows, key, time, value, limit, F.col(free), tie).drop(free),
        seeds=lambda last: last,
        remember=lambda rows, out: latest(rows.drop(SEED), key, time, tie),
        late=None if late is None else lambda rows, number: late(rows.drop(free), number), delay=delay,
    )


def stream_accept_within(stream: DataFrame, key, time: str, value: str, tie: str, path: str, sink: Sink,
                         limit: float = 10, late: Sink | None = None, delay: float | None = None) -> DataStreamWriter:
    """Values within the limit of the last accepted one, across batches.

    The last row taken and the last accepted value may be different rows: the value is
    remembered next to the last row and goes in front of the next batch at its time.
    """
    accepted = f"_{value}"

    def seeds(last: DataFrame) -> DataFrame:
        return last.filter(F.col(accepted).isNotNull()).withColumn(value, F.col(accepted))

    def remember(rows: DataFrame, out: DataFrame) -> DataFrame:
        values = latest(out.drop(SEED), key, time, tie).select(*_keys(key), F.col(value).alias(accepted))
        return latest(rows.drop(SEED), key, time, tie).join(values, _keys(key), "left")

    return _run(
        stream, key, time, tie, path, sink,
        operator=lambda rows: accept_within(rows, key, time, value, limit, tie), seeds=seeds, remember=remember,
        late=late, delay=delay,
    )


def stream_latch_with_commands(stream: DataFrame, key, time: str, value: str, command: str, tie: str, path: str,
                               sink: Sink, on: float = 26, off: float = 22, vent: str = "v5", late: Sink | None = None,
                               delay: float | None = None) -> DataStreamWriter:
    """State and mode after each row, across batches.

    What is remembered is said again in front of the next batch: the last reading, a
    command for the state, a command for the mode. Replayed, they lead to that state.
    """
    kind = stream.schema[value].dataType

    def seeds(last: DataFrame) -> DataFrame:
        said = [
            (3, F.col("temp"), F.lit(None).cast("string")),
            (2, F.lit(None), F.when(F.col("state") == ON, f"{vent}_on").otherwise(f"{vent}_off")),
            (1, F.lit(None), F.when(F.col("auto") == ON, AUTO_ON).otherwise(AUTO_OFF)),
        ]
        parts = [
            last.select(
                *_keys(key), F.timestamp_add("MICROSECOND", F.lit(-before), F.col(time)).alias(time), tie,
                reading.cast(kind).alias(value), text.alias(command),
            )
            for before, reading, text in said
        ]
        return reduce(DataFrame.unionByName, parts)

    def remember(rows: DataFrame, out: DataFrame) -> DataFrame:
        return latest(out.filter(~F.col(SEED)).select(*_keys(key), time, tie, "temp", "auto", "state"), key, time, tie)

    return _run(
        stream.select(*_keys(key), time, tie, value, command), key, time, tie, path, sink,
        operator=lambda rows: latch_with_commands(
            rows, key, time, value, command, on=on, off=off, vent=vent, tie=tie
        ),
        seeds=seeds, remember=remember, late=late, delay=delay,
    )


def watch_rows(lines: DataFrame, polls: DataFrame, key: str = "controller", time: str = "time") -> DataFrame:
    """Log lines and polls as one frame, which a stream of the watch takes."""
    nothing = [F.lit(None).cast(lines.schema[c].dataType).alias(c) for c in lines.columns if c not in (key, time)]
    asked = polls.select(key, time, *nothing).select(*lines.columns).withColumn(POLL, F.lit(True))
    return lines.withColumn(POLL, F.lit(False)).unionByName(asked)


def stream_watch(rows: DataFrame, registry: DataFrame, path: str, sink: Sink, delay: float = 0, late: Sink | None = None,
                 patience: int = 5, waits: tuple[int, int] = (100, 200), watch_only: bool = False,
                 key: str = "controller", time: str = "time", position: str = "position") -> DataStreamWriter:
    """Restart and reboot decisions from log lines and polls (:func:`watch_rows`), across batches.

    A poll is decided when the mark has passed it, so however its lines and those of other polls are cut into batches,
    and whatever order they have within ``delay``, the decisions are those of the batch operators. Three things are
    kept: the last event read of each station, events that no poll has read yet, and a state per controller.
    """
    station = [key, "cell"]

    def last_read(events: DataFrame) -> DataFrame:
        rest = [c for c in events.columns if c not in station]
        row = F.max_by(F.struct(*rest), F.struct(time, *LINE)).alias("_row")
        return events.groupBy(*station).agg(row).select(*station, "_row.*").select(*events.columns)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known, unread = CurrentTable(spark, f"{path}/known", station), CurrentTable(spark, f"{path}/unread")
        states = CurrentTable(spark, f"{path}/states", key)
        with held(batch) as arrived:
            ready, refused, _ = Waiting(spark, f"{path}/waiting", time, delay).release(arrived, number)
            if late is not None:
                late(refused, number)
            with written(ready, f"{path}/ready") as taken:
                polls = taken.filter(POLL).select(key, time)
                events, left = cell_events(taken.filter(~F.col(POLL)).drop(POLL)), unread.read(before=number)
                pool = events if left is None else events.unionByName(left)
                old, start = known.read(before=number), states.read(before=number)
                with (written(pool, f"{path}/pool") as all_events,
                      written(seen_events(all_events, polls, key, time).select(*pool.columns), f"{path}/read") as read):
                    so_far = read if old is None else read.unionByName(old)
                    with written(first_failing_steps(so_far, registry, polls, key, time, position), f"{path}/seen") as seen:
                        sink(escalate_watch(seen, key, time, patience, waits, watch_only, start, polls), number)
                        with held(final_states(seen, key, time, patience, waits, watch_only, start, polls)) as ended:
                            states.merge(ended, number, lambda was, now: was.join(now.select(key), key, "left_anti").unionByName(now))
                    known.merge(read, number, lambda was, now: last_read(was.unionByName(now)))
                    last = polls.groupBy(key).agg(F.max(time).alias("_last"))
                    open_ = F.col("_last").isNull() | (F.col(time) > F.col("_last"))
                    unread.replace(all_events.join(last, key, "left").filter(open_).select(*all_events.columns), number)

    return rows.writeStream.foreachBatch(write)


def stream_sessions(stream: DataFrame, key, time: str, gap: float, path: str, sink: Sink, delay: float,
                    late: Sink | None = None) -> DataStreamWriter:
    """Stretches of readings without a longer gap, given out once the mark is ``gap`` seconds past their end.

    A key's open stretch is remembered and stands in front of its new readings as one row. Stretches are numbered by a
    running sum along the key, which is cut into slices where it is heavy, and then summed up before they move.
    """
    keys = _keys(key)
    gap_us = round(gap * 1_000_000)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        table = CurrentTable(spark, f"{path}/open")
        opened = table.read(before=number)
        with held(batch.select(*keys, time)) as arrived:
            ready, refused, mark = Waiting(spark, f"{path}/waiting", time, delay).release(arrived, number)
            if late is not None:
                late(refused, number)
            rows = ready.select(*keys, F.col(time).alias("first_read"), F.col(time).alias("last_read"), F.lit(1).cast("long").alias("reads"))
            if opened is not None:
                rows = rows.unionByName(opened)
            with written(rows, f"{path}/taken") as taken:
                line = Timeline.of(taken, keys, "first_read", "last_read").previous("_before", "last_read")
                apart = elapsed_us("_before.last_read", "first_read") > gap_us
                numbered = line.running(_n=F.when(apart, 1).otherwise(0)).rows()
                stretches = numbered.groupBy(*keys, "_n").agg(
                    F.min("first_read").alias("first_read"), F.max("last_read").alias("last_read"), F.sum("reads").alias("reads")
                ).drop("_n")
                with held(stretches) as found:
                    over = F.lit(False) if mark is None else micros(found, "last_read") + gap_us <= mark
                    sink(found.filter(over), number)
                    table.replace(found.filter(~over), number)

    return stream.writeStream.foreachBatch(write)


def file_sink(path: str) -> Sink:
    """Each batch's output under its own directory, replaced when the batch runs again."""

    def write(out: DataFrame, number: int) -> None:
        out.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write

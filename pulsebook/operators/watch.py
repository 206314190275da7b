"""The station watch: which stations are off as of each poll, and which of them a poll stops at.

A poll reads the whole log of its day, so an event counts from the first poll at or after it on the same day; what
comes after the last poll of a day is never read. A station is off while its last event read is an ``off``. A poll
stops at the first such station in list order; stations marked ``not`` are passed over.

After an action the watch forgets what it knew and reads the log of the day of the next poll anew: a station whose
``off`` is in an older log is then taken for on. So a poll is described by a few steps (since, position, cell): the
first station in the list among those whose ``off`` is in the log of day ``since`` or a later one, for each day where
that changes the answer, latest day first. The last step is the first station off at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsebook.operators.passes import group_starts, in_order, key_at, record_batch
from pulsebook.operators.timeline import CUT, SLICE, Timeline

FAILING = "failing"
NEVER = "not"
LINE = ["log_date", "line_no", "nth"]
_TURN, _POLL = "_turn", "_poll"


def seen_events(events: DataFrame, polls: DataFrame, key: str = "controller", time: str = "time") -> DataFrame:
    """The events that some poll reads: those not after the last poll of the day of their log."""
    last = polls.groupBy(key, F.to_date(time).alias("log_date")).agg(F.max(time).alias("_last"))
    return events.join(last, [key, "log_date"]).filter(F.col(time) <= F.col("_last")).drop("_last")


def monitored(registry: DataFrame, key: str = "controller", position: str = "position") -> DataFrame:
    """Stations that are checked, with their place in the list."""
    checked = F.coalesce(F.col("check") != NEVER, F.lit(True))
    return registry.filter(checked).select(key, "cell", F.col(position).alias("position"))


def first_failing_steps(events: DataFrame, registry: DataFrame, polls: DataFrame, key: str = "controller",
                        time: str = "time", position: str = "position") -> DataFrame:
    """One row per poll: key, time and ``failing``, the steps of the module's text; none when all stations are on.

    ``events`` are read events: ``log_date``, ``line_no``, ``nth``, ``cell`` and ``event``. Polls of one time are one.
    A busy controller is cut into time slices; the stations that are off at a border are put in front of the slice.
    """
    listed = monitored(registry, key, position)
    cell = listed.schema["cell"]
    about = events.withColumn("cell", F.col("cell").cast(cell.dataType)).join(listed, [key, "cell"]).select(
        key, time, F.lit(1).alias(_TURN), F.lit(False).alias(_POLL), *LINE, "position", "cell", (F.col("event") == "off").alias("off"),
    )
    nothing = [F.lit(None).cast(about.schema[c].dataType).alias(c) for c in [*LINE, "position", "cell", "off"]]
    asked = polls.select(key, time).distinct().select(key, time, F.lit(1).alias(_TURN), F.lit(True).alias(_POLL), *nothing)
    line = Timeline.of(about.unionByName(asked), key, time)
    order = [_TURN, time, _POLL, *LINE]
    rows = line.df.drop(CUT).unionByName(_at_borders(line, [time, *LINE]))
    swept = Timeline(rows, line.key, order)
    step = T.StructType().add("since", T.DateType()).add("position", listed.schema["position"].dataType).add("cell", cell.dataType)
    parts = line.parts
    out = T.StructType([swept.df.schema[c] for c in [*parts, time]]).add(FAILING, T.ArrayType(step))
    return in_order(swept).mapInArrow(_sweep(parts, time, out), out).drop(SLICE)


def _at_borders(line: Timeline, order: list[str]) -> DataFrame:
    """For each slice of a heavy key the stations that are off when it begins, as rows in front of it."""
    heavy, key = line.heavy(), line.key
    station = [*key, "position", "cell"]
    said = F.max_by(F.struct(*order, "off"), F.struct(*order))
    last = heavy.filter(~F.col(_POLL)).groupBy(*station, SLICE).agg(said.alias("_last"))
    until = Window.partitionBy(*station).orderBy(SLICE)
    ends = heavy.groupBy(*key).agg(F.max(SLICE).alias("_end"))
    held = last.withColumn("_next", F.lead(SLICE).over(until)).filter("_last.off").join(ends, key)
    covers = F.sequence(F.col(SLICE) + 1, F.coalesce("_next", "_end"))
    spread = held.filter(F.col(SLICE) < F.col("_end")).withColumn(SLICE, F.explode(covers))
    said = {c: F.col(f"_last.{c}") for c in [*order, "off"]} | {_TURN: F.lit(0), _POLL: F.lit(False)}
    return spread.select(*[said.get(c, F.col(c)).alias(c) for c in line.df.columns if c != CUT])


class OpenStations:
    """Stations that are off, by the day of the log that says so; heaps drop closed ones when they come up."""

    def __init__(self) -> None:
        self.since: dict[tuple, object] = {}
        self.by_day: dict[object, list[tuple]] = {}
        self.found: list[tuple] | None = []

    def take(self, station: tuple, day, off: bool) -> None:
        before = self.since.get(station)
        if before == (day if off else None):
            return
        self.found = None
        if off:
            self.since[station] = day
            heappush(self.by_day.setdefault(day, []), station)
        else:
            del self.since[station]

    def steps(self) -> list[tuple]:
        if self.found is None:
            self.found, best = [], None
            for day in sorted(self.by_day, reverse=True):
                heap = self.by_day[day]
                while heap and self.since.get(heap[0]) != day:
                    heappop(heap)
                if not heap:
                    del self.by_day[day]
                elif best is None or heap[0] < best:
                    best = heap[0]
                    self.found.append((day, *best))
        return self.found


def _sweep(parts: list[str], time: str, schema: T.StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, stations = None, OpenStations()
        for batch in batches:
            if not batch.num_rows:
                continue
            new = group_starts(batch, parts, group)
            times, asked, days, places, cells, offs = (
                batch.column(c).to_pylist() for c in (time, _POLL, "log_date", "position", "cell", "off")
            )
            out = []
            for i, fresh in enumerate(new):
                if fresh:
                    group, stations = key_at(batch, parts, i), OpenStations()
                if asked[i]:
                    steps = [dict(zip(("since", "position", "cell"), s)) for s in stations.steps()]
                    out.append((*group, times[i], steps))
                else:
                    stations.take((places[i], cells[i]), days[i], offs[i])
            if out:
                yield record_batch(out, schema)

    return run


def first_failing_cell(steps: Column | str = FAILING) -> Column:
    """The first station in the list that is off, null when none is."""
    steps = F.col(steps) if isinstance(steps, str) else steps
    return F.try_element_at(steps, F.lit(-1)).cell

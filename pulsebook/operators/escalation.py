"""Patience with failing stations, and the actions once it has run out."""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsebook.operators.passes import group_starts, in_order, key_at, record_batch
from pulsebook.operators.timeline import SLICE, Timeline, beside
from pulsebook.operators.watch import FAILING

START = "_start"
# The two actions.
RESTART, REBOOT = "restart", "reboot"
# What a poll may do to a controller's memory, besides; the last one is a healthy poll on a locked day.
HEALTHY, LOCKED = "healthy", "healthy_locked"
RESETS = [RESTART, REBOOT, HEALTHY, LOCKED]


def first_failing(polls: DataFrame, key, time: str, cell: str, status: str, position: str) -> DataFrame:
    """Per poll the first failing cell in list order, null when all are on."""
    keys = [key] if isinstance(key, str) else list(key)
    bad = F.when(F.col(status) == "off", F.col(position))
    return polls.groupBy(*keys, time).agg(F.min_by(cell, bad).alias(cell))


def patience(polls: DataFrame, key, time: str, cell: str, status: str, position: str) -> DataFrame:
    """Patience counter of the cell counted at each failing poll; a healthy poll resets all."""
    return patience_counters(first_failing(polls, key, time, cell, status, position), key, time, cell)


def patience_counters(seen: DataFrame, key, time: str, cell: str, like: DataFrame | None = None) -> DataFrame:
    """The same from one row per poll with its first failing cell, null when all are on. ``like``: see ``Timeline.of``."""
    keys = [key] if isinstance(key, str) else list(key)
    line = Timeline.of(seen, keys, time, like=like)
    parts, window = line.parts, line.window()
    healthy = F.when(F.col(cell).isNull(), 1).otherwise(0)
    line = line.with_rows(line.df.withColumns({
        "_resets": F.sum(healthy).over(window),
        "_all": F.sum(healthy).over(window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    }))
    own = F.row_number().over(Window.partitionBy(*parts, "_resets", cell).orderBy(time))
    counted = line.df.filter(F.col(cell).isNotNull()).withColumn("_own", own)
    # A healthy poll in a slice wipes what came before; without one the counters go on.
    counted = beside(counted, _held_counts(line, cell), [*parts, cell], bounded=False)
    before = F.when(F.col("_resets") == 0, F.coalesce("_held", F.lit(0))).otherwise(0)
    return line.with_rows(counted.withColumn("counter", (F.col("_own") + before).cast("bigint"))).rows().drop("_resets", "_all", "_own", "_held")


def _held_counts(line: Timeline, cell: str) -> DataFrame:
    """For each slice of a heavy key and each of its failing cells what was counted since the last healthy poll before.

    An era begins with each slice that has a healthy poll; its cells' counts after that poll add up until the next.
    """
    heavy, key, parts = line.heavy(), line.key, line.parts
    wiped = heavy.groupBy(*parts).agg(F.max("_all").alias("_all")).withColumn("_wipes", F.when(F.col("_all") > 0, 1).otherwise(0))
    eras = wiped.select(*parts, "_wipes", F.sum("_wipes").over(Window.partitionBy(*key).orderBy(SLICE)).alias("_era"))
    left = F.sum(F.when(F.col("_resets") == F.col("_all"), 1).otherwise(0)).alias("_left")
    tails = heavy.filter(F.col(cell).isNotNull()).groupBy(*parts, cell).agg(left)
    # One row per slice of a heavy key.
    tails = beside(tails, eras, parts)
    listed = tails.select(*parts, cell, F.inline(F.array(
        F.struct(F.lit(0).alias("_turn"), (F.col("_era") - F.col("_wipes")).alias("_era"), F.lit(0).cast("bigint").alias("_left")),
        F.struct(F.lit(1).alias("_turn"), F.col("_era").alias("_era"), F.col("_left").alias("_left")),
    )))
    so_far = Window.partitionBy(*key, cell, "_era").orderBy(SLICE, "_turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return listed.withColumn("_held", F.sum("_left").over(so_far)).filter("_turn = 0").select(*parts, cell, "_held")


class Escalation:
    """The state of one controller between polls.

    ``floor`` is the day whose log and later ones the watch remembers; none right after an action, until the next
    poll. Days are ordinals. ``reset`` is what the last poll did to the memory, one of ``RESETS`` or none.
    """

    def __init__(self, patience: int, waits: tuple[int, int], watch_only: bool, text: str | None = None) -> None:
        self.patience, self.waits, self.watch_only = patience, waits, watch_only
        s = json.loads(text) if text else {}
        self.counts: dict[str, int] = s.get("counts", {})
        self.again: bool = s.get("again", False)
        self.lock: int | None = s.get("lock")
        self.resume = datetime.fromisoformat(s["resume"]) if s.get("resume") else None
        self.floor: int | None = s.get("floor")
        self.reset: str | None = None

    def like(self, **changed) -> Escalation:
        """A machine with the same rules and the given state, else that of this one."""
        other = object.__new__(Escalation)
        other.__dict__.update(self.__dict__, counts=dict(self.counts), reset=None)
        other.__dict__.update(changed)
        return other

    def text(self) -> str:
        resume = self.resume.isoformat() if self.resume is not None else None
        return json.dumps(
            {"counts": self.counts, "again": self.again, "lock": self.lock, "resume": resume, "floor": self.floor},
            sort_keys=True,
        )

    def state(self) -> tuple:
        return frozenset(self.counts.items()), self.again, self.lock, self.resume, self.floor

    def first(self, failing: list[dict]):
        """The first failing station of those in memory."""
        for step in reversed(failing):
            if step["since"].toordinal() >= self.floor:
                return step["cell"]
        return None

    def poll(self, time: datetime, failing: list[dict]) -> tuple | None:
        """Take one poll; returns the station, the action and its pause when there is one."""
        self.reset = None
        if self.resume is not None:
            if time < self.resume:
                return None
            self.resume = None
        today = time.toordinal()
        if self.lock != today:
            self.lock = None
        if self.floor is None:
            self.floor = today
        cell = self.first(failing)
        if cell is None:
            self.counts, self.again, self.floor = {}, False, today
            self.reset = HEALTHY if self.lock is None else LOCKED
            return None
        name = str(cell)
        # Beyond the threshold the exact count no longer matters.
        self.counts[name] = min(self.counts.get(name, 0) + 1, self.patience + 1)
        if self.watch_only or self.counts[name] <= self.patience or self.lock == today:
            return None
        self.reset = REBOOT if self.again else RESTART
        pause = self.waits[1 if self.again else 0]
        self.__dict__.update(after(self.reset, time, pause))
        return cell, self.reset, pause


def after(reset: str, time: datetime, pause: int = 0) -> dict:
    """The whole state of a controller after a reset at that time; nothing older matters any more."""
    today = time.toordinal()
    if reset in (HEALTHY, LOCKED):
        return {"counts": {}, "again": False, "lock": today if reset == LOCKED else None, "resume": None, "floor": today}
    lock = today if reset == REBOOT else None
    return {"counts": {}, "again": reset == RESTART, "lock": lock, "resume": time + timedelta(seconds=pause), "floor": None}


class SliceTable:
    """What a slice of a controller's polls does to any state it may begin with.

    A state matters only until its first reset. So the polls are kept up to the one by which every state has met a
    reset, and for each of these the state at the end of the slice after each kind of reset there. All these runs go
    on side by side and become one as soon as they agree.

    The last to meet a reset is a state that has counted nothing, is locked for the day and has just begun the longest
    pause; it is followed for every class of ``floor`` that the polls tell apart.
    """

    def __init__(self, rules: Escalation, time: datetime) -> None:
        self.rules = rules
        today, longest = time.toordinal(), time + timedelta(seconds=max(rules.waits))
        late = rules.like(counts={}, again=False, lock=today, resume=longest)
        # Floors above the first and up to the second; the first class reaches back without end.
        self.classes = [(0, today, late.like(floor=today))]
        self.classes += [(d - 1, d, late.like(floor=d)) for d in range(today + 1, longest.toordinal() + 1)]
        self.head: list[tuple[datetime, list[dict]]] = []
        self.runs: list[tuple[Escalation, list[tuple[int, str]]]] = []

    def take(self, time: datetime, failing: list[dict]) -> None:
        for machine, _ in self.runs:
            machine.poll(time, failing)
        if self.classes:
            self._grow(time, failing)
        if len(self.runs) > 1:
            alike: dict[tuple, tuple] = {}
            for machine, begun in self.runs:
                alike.setdefault(machine.state(), (machine, []))[1].extend(begun)
            self.runs = list(alike.values())

    def _grow(self, time: datetime, failing: list[dict]) -> None:
        for day in {s["since"].toordinal() for s in failing}:
            for lo, hi, machine in [c for c in self.classes if c[0] < day < c[1]]:
                self.classes.remove((lo, hi, machine))
                self.classes += [(lo, day, machine.like(floor=day)), (day, hi, machine)]
        for found in list(self.classes):
            found[2].poll(time, failing)
            if found[2].reset:
                self.classes.remove(found)
        at, today = len(self.head), time.toordinal()
        self.head.append((time, failing))
        kinds = [RESTART, REBOOT] if failing and not self.rules.watch_only else []
        # A poll with failing stations is healthy to a memory that does not reach back to them.
        if not failing or failing[0]["since"].toordinal() < today:
            kinds += [HEALTHY, LOCKED]
        pauses = dict(zip((RESTART, REBOOT), self.rules.waits))
        for kind in kinds:
            self.runs.append((self.rules.like(**after(kind, time, pauses.get(kind, 0))), [(at, kind)]))

    def rows(self) -> list[tuple]:
        """For each kept poll its number, time and steps, and the end of the slice after each kind of reset."""
        ends = {key: machine.text() for machine, begun in self.runs for key in begun}
        return [(i, t, f, *(ends.get((i, kind)) for kind in RESETS)) for i, (t, f) in enumerate(self.head)]


def escalate(polls: DataFrame, key, time: str, cell: str, status: str, position: str, patience: int = 5,
             waits: tuple[int, int] = (100, 200), watch_only: bool = False) -> DataFrame:
    """Decisions from the status of every station at every poll; nothing is forgotten but counts.

    See :func:`escalate_watch` for the rules.
    """
    keys = [key] if isinstance(key, str) else list(key)
    seen = first_failing(polls, keys, time, cell, status, position)
    step = F.struct(F.to_date(time).alias("since"), F.lit(0).alias("position"), F.col(cell).alias("cell"))
    steps = F.filter(F.array(step), lambda s: s.cell.isNotNull())
    made = escalate_watch(seen.select(*keys, time, steps.alias(FAILING)), keys, time, patience, waits, watch_only)
    return made.withColumnRenamed("cell", cell)


def escalate_watch(seen: DataFrame, key, time: str, patience: int = 5, waits: tuple[int, int] = (100, 200),
                   watch_only: bool = False, start: DataFrame | None = None, like: DataFrame | None = None) -> DataFrame:
    """Decisions per controller: restart when patience runs out, reboot the next time.

    ``seen`` has one row per poll with its ``failing`` steps. After a reboot the controller is left alone for the rest
    of the day; after either, polls within the pause are not looked at. ``start`` holds ``state`` texts by key, ``like``
    the polls where they are to be had without their steps.

    A heavy controller is cut into slices: a first pass works out what each does to any state (:class:`SliceTable`),
    these are chained per key, and a second pass runs every slice from its true start.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rules = Escalation(patience, waits, watch_only)
    line = _with_starts(Timeline.of(seen, keys, time, like=like), time, rules, start)
    step = seen.schema[FAILING].dataType.elementType
    out = T.StructType([line.df.schema[c] for c in [*keys, time]]).add("cell", step["cell"].dataType)
    return _run(line, time, rules, out.add("action", T.StringType()).add("pause_s", T.IntegerType()), finals=False)


def final_states(seen: DataFrame, key, time: str, patience: int = 5, waits: tuple[int, int] = (100, 200),
                 watch_only: bool = False, start: DataFrame | None = None, like: DataFrame | None = None) -> DataFrame:
    """The ``state`` of each controller after its polls."""
    keys = [key] if isinstance(key, str) else list(key)
    rules = Escalation(patience, waits, watch_only)
    line = _with_starts(Timeline.of(seen, keys, time, like=like), time, rules, start)
    ends = _run(line, time, rules, T.StructType([line.df.schema[c] for c in line.parts]).add("state", T.StringType()), finals=True)
    return ends.groupBy(*keys).agg(F.max_by("state", SLICE).alias("state"))


def _run(line: Timeline, time: str, rules: Escalation, schema: T.StructType, finals: bool) -> DataFrame:
    parts, keys = line.parts, len(line.key)
    patience, waits, watch_only = rules.patience, rules.waits, rules.watch_only

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, group = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = group_starts(batch, parts, group)
            times, steps = batch.column(time).to_pylist(), batch.column(FAILING).to_pylist()
            rows = []
            for i, (t, failing, fresh) in enumerate(zip(times, steps, new)):
                if fresh:
                    if finals and state is not None:
                        rows.append((*group, state.text()))
                    group = key_at(batch, parts, i)
                    state = Escalation(patience, waits, watch_only, batch.column(START)[i].as_py())
                decision = state.poll(t, failing)
                if decision and not finals:
                    rows.append((*group[:keys], t, *decision))
            if rows:
                yield record_batch(rows, schema)
        if finals and state is not None:
            yield record_batch([(*group, state.text())], schema)

    return in_order(line).mapInArrow(fold, schema)


def _with_starts(line: Timeline, time: str, rules: Escalation, start: DataFrame | None) -> Timeline:
    """The rows with the state that each key, or slice of a heavy key, begins with."""
    key, parts = line.key, line.parts
    if start is not None:
        start = start.select(*key, F.col("state").alias(START))
    patience, waits, watch_only = rules.patience, rules.waits, rules.watch_only
    heavy = line.with_rows(line.heavy())
    head = T.StructType([line.df.schema[c] for c in parts]).add("_n", T.IntegerType()).add(line.df.schema[time]).add(line.df.schema[FAILING])
    for kind in RESETS:
        head = head.add(kind, T.StringType())

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, group = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = group_starts(batch, parts, group)
            for i, (t, failing, fresh) in enumerate(zip(batch.column(time).to_pylist(), batch.column(FAILING).to_pylist(), new)):
                if fresh:
                    if table is not None:
                        yield record_batch([(*group, *r) for r in table.rows()], head)
                    group, table = key_at(batch, parts, i), SliceTable(Escalation(patience, waits, watch_only), t)
                table.take(t, failing)
        if table is not None:
            yield record_batch([(*group, *r) for r in table.rows()], head)

    heads = in_order(heavy).mapInArrow(tables, head)
    heads = heads.withColumn(START, F.lit(None).cast("string")) if start is None else beside(heads, start, key, bounded=False)
    begins = T.StructType([line.df.schema[c] for c in parts]).add(START, T.StringType())

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Slices of a key in order: a slice's table says where the state goes that the one before ended in."""
        state, name, at, settled = None, None, None, False
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                own = tuple(row[c] for c in key)
                if own != name:
                    state, name, at = Escalation(patience, waits, watch_only, row[START]), own, None
                if row[SLICE] != at:
                    at, settled = row[SLICE], False
                    out.append((*own, at, state.text()))
                if settled:
                    continue
                state.poll(row[time], row[FAILING])
                if state.reset:
                    state, settled = Escalation(patience, waits, watch_only, row[state.reset]), True
            if out:
                yield record_batch(out, begins)

    starts = heads.repartition(*key).sortWithinPartitions(*parts, "_n").mapInArrow(chain, begins)
    # One row per slice of a heavy key.
    rows = beside(line.df, starts, parts)
    if start is not None:
        given = start.withColumnRenamed(START, "_given")
        rows = beside(rows, given, key, bounded=False)
        rows = rows.withColumn(START, F.when(F.col(SLICE) < 0, F.col("_given")).otherwise(F.col(START))).drop("_given")
    return line.with_rows(rows)


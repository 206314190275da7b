"""Folds whose next step depends on their own last decision.

These run in Python over Arrow batches: Spark partitions by key (and slice, for heavy
keys) and sorts, so a task reads its rows in order, keeps one small state at a time
and never holds a key's history.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsebook.functions.values import differs
from pulsebook.operators.passes import floats, group_starts, in_order, key_at, record_batch
from pulsebook.operators.timeline import Timeline, beside

START = "_start"


# -- acceptance against the last accepted value ------------------------------------


def accept_batch(values, new, starts, last, limit):
    """Which values lie within ``limit`` of the last accepted one; a first value seeds."""
    keep = [False] * len(values)
    for i, (v, fresh) in enumerate(zip(values, new)):
        if fresh:
            last = starts[i] if starts[i] == starts[i] else None
        if v != v:
            continue
        if last is None or v - limit <= last <= v + limit:
            keep[i] = True
            last = v
    return keep, last


class Starts:
    """Intervals of starting values that go on alike, put in order when they have doubled."""

    def __init__(self) -> None:
        self.pieces: list[tuple] = []
        self.tidy = 64

    def take(self, more: list[tuple]) -> None:
        self.pieces.extend(more)
        if len(self.pieces) > self.tidy:
            self.pieces = joined(self.pieces)
            self.tidy = max(64, 2 * len(self.pieces))


class Reach:
    """What a slice does to every value it could start from.

    All starting values that accept the same reading go on alike, so the slice is
    described by a few intervals of starting values, each with the value it ends at.
    Values in no interval accept nothing and stay. Groups are kept in the order of
    their current values, which are more than the limit apart, and open intervals in
    theirs, so a reading finds the few it touches by bisection.
    """

    def __init__(self, limit: float) -> None:
        self.limit = limit
        # Open intervals that accepted nothing so far.
        self.free_from, self.free_to = [-math.inf], [math.inf]
        self.at: list[float] = []
        self.groups: list[Starts] = []
        self.seed: Starts | None = None

    def add(self, x: float) -> None:
        lo, hi = x - self.limit, x + self.limit
        i, j = bisect_left(self.at, lo), bisect_right(self.at, hi)
        f, g = bisect_right(self.free_to, lo), bisect_left(self.free_from, hi)
        if i == j and f == g:
            return
        met = self.groups[i:j]
        group = max(met, key=lambda s: len(s.pieces), default=None) or Starts()
        for other in met:
            if other is not group:
                group.take(other.pieces)
        free = list(zip(self.free_from[f:g], self.free_to[f:g]))
        if free:
            group.take([(max(a, lo), lo > a, min(b, hi), hi < b) for a, b in free])
            left = [(a, lo) for a, _ in free[:1] if a < lo] + [(hi, b) for _, b in free[-1:] if hi < b]
            self.free_from[f:g], self.free_to[f:g] = [a for a, _ in left], [b for _, b in left]
        if self.seed is None or any(s is self.seed for s in met):
            self.seed = group
        self.at[i:j], self.groups[i:j] = [x], [group]

    def rows(self) -> list[tuple]:
        return [
            (lo, lc, hi, hc, x, group is self.seed)
            for x, group in zip(self.at, self.groups) for lo, lc, hi, hc in joined(group.pieces)
        ]


def joined(pieces: list[tuple]) -> list[tuple]:
    out: list[tuple] = []
    for p in sorted(pieces):
        if out and p[0] == out[-1][2] and (p[1] or out[-1][3]):
            out[-1] = (out[-1][0], out[-1][1], p[2], p[3])
        else:
            out.append(p)
    return out


def _reach_schema(df: DataFrame, parts: list[str]) -> T.StructType:
    schema = T.StructType([df.schema[c] for c in parts])
    for bound in ("lo", "hi"):
        schema = schema.add(bound, T.DoubleType()).add(f"{bound}_in", T.BooleanType())
    return schema.add("ends", T.DoubleType()).add("seed", T.BooleanType())


def _slice_starts(line: Timeline, value: str, limit: float) -> DataFrame:
    """The value each slice of a heavy key starts from; bounded by the number of slices."""
    parts, key = line.parts, line.key
    thin = line.with_rows(line.heavy().select(*parts, *line.order, F.col(value).cast("double").alias("_v")))
    piece_type = _reach_schema(thin.df, parts)

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, group = None, None

        def flush() -> Iterator[pa.RecordBatch]:
            if state is not None and state.groups:
                yield record_batch([(*group, *r) for r in state.rows()], piece_type)

        for batch in batches:
            if not batch.num_rows:
                continue
            new = group_starts(batch, parts, group)
            for i, (v, fresh) in enumerate(zip(floats(batch, "_v"), new)):
                if fresh:
                    yield from flush()
                    state, group = Reach(limit), key_at(batch, parts, i)
                if v == v:
                    state.add(v)
        yield from flush()

    pieces = in_order(thin).mapInArrow(reach, piece_type)
    begins = T.StructType([thin.df.schema[c] for c in parts]).add(START, T.DoubleType())

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Slices of a key in order; what is held is one value, whatever their intervals."""
        state, ends, group = math.nan, math.nan, None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = group_starts(batch, parts, group)
            starts = [i for i, fresh in enumerate(new) if fresh or not i]
            lo, hi, end = (batch.column(c).to_numpy() for c in ("lo", "hi", "ends"))
            lo_in, hi_in, seed = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("lo_in", "hi_in", "seed"))
            out = []
            for a, b in zip(starts, [*starts[1:], batch.num_rows]):
                if new[a]:
                    before, group = group, key_at(batch, parts, a)
                    state = ends if before is not None and before[:-1] == group[:-1] else math.nan
                    ends = state
                    out.append((*group, state))
                if math.isnan(state):
                    hit = seed[a:b]
                else:
                    hit = (lo[a:b] < state) | ((lo[a:b] == state) & lo_in[a:b])
                    hit &= (hi[a:b] > state) | ((hi[a:b] == state) & hi_in[a:b])
                found = np.flatnonzero(hit)
                if len(found):
                    ends = float(end[a + found[0]])
            if out:
                yield record_batch(out, begins)

    return pieces.repartition(*key).sortWithinPartitions(*parts, "lo").mapInArrow(chain, begins)


def accept_within(df: DataFrame, key, time: str, value: str, limit: float = 10,
                  tie: str | None = None) -> DataFrame:
    """Rows within ``limit`` (inclusive) of the key's last accepted value.

    A heavy key is cut into slices: a first pass works out what each slice does to any
    starting value, these are chained per key, and the second pass runs every slice
    from its true start. The answer is the same as from one long fold.
    """
    line = Timeline.of(df, key, time, tie)
    # One row per slice of a heavy key.
    line = line.with_rows(beside(line.df, _slice_starts(line, value, limit), line.parts))
    parts = line.parts

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, last = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = group_starts(batch, parts, group)
            keep, last = accept_batch(floats(batch, value), new, floats(batch, START), last, limit)
            group = key_at(batch, parts, batch.num_rows - 1)
            yield batch.filter(pa.array(keep))

    return in_order(line).mapInArrow(fold, line.df.schema).select(*df.columns)


# -- run index ---------------------------------------------------------------------


def run_index(df: DataFrame, order: str, group: str, wrap: bool = True, out: str = "run",
              like: DataFrame | None = None) -> DataFrame:
    """Number of the run of equal group values each row is in, in display order.

    With ``wrap`` the first row is compared with the last one, so numbering starts at 1
    when they differ and at 0 when they do not. ``like`` is a frame whose ``order`` values
    lie as those of ``df`` and are cheaper to have.
    """
    everything = F.lit(0).alias("_all")
    line = Timeline.of(
        df.select("*", everything), "_all", order, like=None if like is None else like.select(order, everything)
    ).previous("_before", group)
    first, opens = F.col("_before").isNull(), F.lit(False)
    if wrap:
        line = line.last("_last", group)
        opens = differs(group, F.col(f"_last.{group}"))
    changed: Column = F.when(first, opens).otherwise(differs(group, F.col(f"_before.{group}")))
    line = line.running(**{out: changed.cast("int")})
    rows = line.rows().drop("_all", "_before", "_last")
    return rows.withColumn(out, F.col(out).cast("int"))


# Colours of the runs, in order; a later run has none.
RUN_COLOURS = ["FFFFFF", "E9E9E9", "E8DBB3", "E9E9E9", "CFEAF3", "F9F9F9", "F4F4AD"]


def run_colour(run: Column | str) -> Column:
    c = F.col(run) if isinstance(run, str) else run
    return F.get(F.array(*[F.lit(x) for x in RUN_COLOURS]), c)

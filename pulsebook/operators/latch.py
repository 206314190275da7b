"""Two-set-point control with manual commands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsebook.functions.bands import OFF, ON
from pulsebook.operators.changes import changes
from pulsebook.operators.timeline import Timeline

AUTO_ON, AUTO_OFF = "auto_on", "auto_off"


def wanted(value: Column, on: float, off: float) -> Column:
    """What a reading asks for: on above the upper set point, off below the lower, else nothing."""
    return F.when(value > on, ON).when(value < off, OFF)


def latch(df: DataFrame, key, time: str, value: str, on: float = 26, off: float = 22, initial: str = OFF,
          tie: str | None = None, out: str = "state") -> DataFrame:
    """State after each reading; between the set points it holds."""
    line = Timeline.of(df, key, time, tie).carry(**{out: wanted(F.col(value), on, off)})
    return line.rows().withColumn(out, F.coalesce(out, F.lit(initial)))


def merge_events(readings: DataFrame, commands: DataFrame, key, time: str, value: str, command: str,
                 tie: str) -> DataFrame:
    """Readings and commands as one stream of rows."""
    keys = [key] if isinstance(key, str) else list(key)
    r = readings.select(*keys, time, tie, value, F.lit(None).cast("string").alias(command))
    c = commands.select(*keys, time, tie, F.lit(None).cast(readings.schema[value].dataType).alias(value), command)
    return r.unionByName(c)


def latch_with_commands(events: DataFrame, key, time: str, value: str, command: str, **rules) -> DataFrame:
    """The rows of :func:`latch_line`."""
    return latch_line(events, key, time, value, command, **rules).rows()


def latch_line(
    events: DataFrame, key, time: str, value: str, command: str, on: float = 26, off: float = 22,
    vent: str = "v5", initial: str = OFF, auto_initial: str = OFF, tie: str | None = None,
) -> Timeline:
    """State and mode after each row of a merged stream of readings and commands.

    With automation on, the last reading decides whenever it is outside the dead band,
    also over a command; inside the band, and with automation off, commands decide.
    """
    mode = F.when(F.col(command) == AUTO_ON, ON).when(F.col(command) == AUTO_OFF, OFF)
    line = Timeline.of(events, key, time, tie).carry(auto=mode, temp=F.col(value))
    line = line.with_rows(line.df.withColumn("auto", F.coalesce("auto", F.lit(auto_initial))))
    manual = F.when(F.col(command) == f"{vent}_on", ON).when(F.col(command) == f"{vent}_off", OFF)
    automatic = F.when(F.col("auto") == ON, wanted(F.col("temp"), on, off))
    line = line.carry(state=F.coalesce(automatic, manual))
    return line.with_rows(line.df.withColumn("state", F.coalesce("state", F.lit(initial))))


def switch_journal(states: DataFrame | Timeline, key, time: str, state: str = "state",
                   tie: str | None = None) -> DataFrame:
    """One row per switch; a timeline goes on with its slices."""
    return changes(states, key, time, [state], tie)

"""Station status from controller logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsebook.operators.timeline import Timeline

# How a log line reports a station. The loose form takes any number before an ``on``.
STATUS = r"cell \d+  (?:off|on)"
LOOSE_STATUS = r"cell \d+  off|\d+  on"


def cell_events(lines: DataFrame, strict: bool = True) -> DataFrame:
    """What log lines say about stations, as (cell, event), with ``nth``: which report of its line it is.

    With ``strict=False`` an ``on`` line switches every station whose number its
    number ends with, so a number is spelled out into its endings and the match
    stays an equality. Most lines are dropped by a plain search before any pattern.
    """
    likely = lines.filter(F.col("line").contains("  off") | F.col("line").contains("  on"))
    pattern = F.lit(STATUS if strict else LOOSE_STATUS)
    reports = F.posexplode(F.regexp_extract_all("line", pattern, F.lit(0))).alias("nth", "said")
    said = likely.select("*", reports).drop("line")
    event = F.when(F.col("said").endswith("off"), "off").otherwise("on")
    found = said.withColumns({"event": event, "cell": F.regexp_extract("said", r"\d+", 0)}).drop("said")
    if strict:
        return found
    endings = F.transform(F.sequence(F.lit(1), F.length("cell")), lambda i: F.substr("cell", i))
    return found.withColumn(
        "cell", F.explode(F.when(F.col("event") == "off", F.array("cell")).otherwise(endings))
    )


def last_event(events: DataFrame, position: list[str]) -> DataFrame:
    """Last event per station. For off/on lines that is where folding them ends up."""
    return events.groupBy("controller", "cell").agg(
        F.max_by("event", F.struct(*position)).alias("event")
    )


def cell_status(lines: DataFrame, registry: DataFrame, strict: bool = True, previous: DataFrame | None = None,
                position: tuple[str, ...] = ("log_date", "line_no")) -> DataFrame:
    """Status of every registered station after the given lines.

    A station without an event keeps its previous status, and is on without one.
    """
    last = last_event(cell_events(lines, strict), [*position, "nth"])
    key = ["controller", "cell"]
    reg = registry.withColumn("cell", F.col("cell").cast("string"))
    out = reg.join(last, key, "left")
    if previous is not None:
        old = previous.select(
            "controller", F.col("cell").cast("string").alias("cell"), F.col("status").alias("_old")
        )
        out = out.join(old, key, "left")
    else:
        out = out.withColumn("_old", F.lit(None).cast("string"))
    status = F.coalesce("event", "_old", F.lit("on"))
    out = out.withColumn("status", status).drop("event", "_old")
    return out.withColumn("cell", F.col("cell").cast(registry.schema["cell"].dataType))


def daily_status(lines: DataFrame, registry: DataFrame, position: str = "line_no") -> DataFrame:
    """Opening and closing status of a station on each day its log mentions it.

    Yesterday's off holds until an on is logged.
    """
    about = lines.withColumns({
        "cell": F.regexp_extract("line", r"cell (\d+)", 1),
        "event": F.nullif(F.regexp_extract("line", r"cell \d+  (off|on)", 1), F.lit("")),
    }).filter(F.col("cell") != "")
    days = about.groupBy("controller", "cell", "log_date").agg(
        F.max_by("event", F.when(F.col("event").isNotNull(), F.col(position))).alias("event")
    )
    reg = registry.select("controller", F.col("cell").cast("string").alias("cell"))
    days = days.join(reg, ["controller", "cell"], "left_semi")
    line = Timeline.of(days, ["controller", "cell"], "log_date").carry(closing=F.col("event"))
    line = line.previous("_before", "closing")
    return line.rows().select(
        "controller", F.col("cell").cast(registry.schema["cell"].dataType).alias("cell"), "log_date",
        F.coalesce("_before.closing", F.lit("on")).alias("opening"),
        F.coalesce("closing", F.lit("on")).alias("closing"),
    )

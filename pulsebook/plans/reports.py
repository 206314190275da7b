"""Boards and reports as rows."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsebook.functions.bands import flag_class, metric_band
from pulsebook.functions.timecols import day_hour, day_window, same_day, to_second
from pulsebook.functions.values import (
    event_class, event_word, from_tenths, ip_key, mains_word, state_word, text_or_null_word,
)
from pulsebook.operators.current import last_n
from pulsebook.operators.folds import run_colour, run_index

HOURS = (0, 3, 6)


def hour_report(snapshots: DataFrame, registry: DataFrame, day: date, hours: tuple[int, ...] = HOURS,
                compat: bool = False) -> DataFrame:
    """Per site system and battery temperature at each hour; sites lacking an hour are left out.

    The earliest row of an hour counts. ``compat`` keeps every combination instead.
    """
    reg = registry.select("ip", "location", "own")
    if compat:
        out = reg
        for h in hours:
            at = snapshots.filter(day_hour("time", day, h)).select(
                "location", F.col("temp_sys").alias(f"sys_{h}"), F.col("temp_akb").alias(f"akb_{h}")
            )
            out = out.join(at, "location")
    else:
        hour = F.hour("time")
        rows = snapshots.filter(same_day("time", day) & hour.isin(*hours))
        first = [
            F.min_by(F.struct("temp_sys", "temp_akb"), F.when(hour == h, F.col("time"))).alias(f"h{h}") for h in hours
        ]
        wide = rows.groupBy("location").agg(*first).dropna(subset=[f"h{h}" for h in hours]).select(
            "location",
            *[F.col(f"h{h}.temp_{m}").alias(f"{m}_{h}") for h in hours for m in ("sys", "akb")],
        )
        out = reg.join(wide, "location")
    return out.select("ip", "own", "location", *[f"{m}_{h}" for h in hours for m in ("sys", "akb")])


def coloured_hour_report(report: DataFrame, hours: tuple[int, ...] = HOURS, sites: DataFrame | None = None) -> DataFrame:
    """The hour report with the class of every cell and the colour of the owner's run.

    ``sites`` is the registry the report was made from; its addresses tell where to cut without the report.
    """
    cells = [(f"{m}_{h}", f"temp_{m}") for h in hours for m in ("sys", "akb")]
    classes = {f"{c}_class": metric_band(c, metric) for c, metric in cells}
    like = None if sites is None else sites.select(ip_key("ip").alias("ip_order"))
    out = run_index(report.withColumns({**classes, "ip_order": ip_key("ip")}), "ip_order", "own", like=like)
    return out.withColumn("run_colour", run_colour("run"))


def state_board(registry: DataFrame, current: DataFrame) -> DataFrame:
    """Every registered device that has been polled, with its state in words."""
    return registry.join(current, "ip").select(
        "ip", ip_key("ip").alias("ip_order"), "name", "description", state_word("state").alias("state"),
        text_or_null_word("visio_name").alias("visio_name"),
    )


def power_board(registry: DataFrame, current: DataFrame) -> DataFrame:
    """Power plants with scaled values and the class of each measured cell."""
    scaled = registry.join(current, "location").select(
        "ip", ip_key("ip").alias("ip_order"), "location", "temp_akb", "temp_sys",
        mains_word("alarm_mains").alias("mains"),
        from_tenths("battery1v", 10).alias("battery1v"), from_tenths("battery2v", 10).alias("battery2v"),
        from_tenths("out_volt", 10).alias("out_volt"), from_tenths("out_ampr", 10).alias("out_ampr"),
        from_tenths("out_watt", 10).alias("out_watt"),
    )
    return scaled.withColumns({
        "akb_class": metric_band("temp_akb", "temp_akb"), "sys_class": metric_band("temp_sys", "temp_sys"),
        "battery1_class": metric_band("battery1v", "battery"), "battery2_class": metric_band("battery2v", "battery"),
    })


def recent_events(changes: DataFrame, registry: DataFrame, n: int = 10, tie: str | None = None) -> DataFrame:
    """The n newest events of registered devices, oldest first, with wording and class."""
    joined = changes.join(registry.select("ip", "name"), "ip")
    newest = [F.col("time").desc()] + ([F.col(tie).desc()] if tie else [])
    top = joined.orderBy(*newest).limit(n)
    return top.orderBy("time", *([tie] if tie else [])).select(
        "ip", "name", to_second("time").alias("ping_time"), event_word("state").alias("event"),
        event_class("state").alias("event_class"),
    )


def day_series(df: DataFrame, as_of: datetime, key: str, values: list[str], time: str = "time") -> DataFrame:
    """Rows of yesterday and today per site, times cut to seconds; sort on ``read_at`` to draw."""
    return df.filter(day_window(time, as_of)).select(
        key, F.col(time).alias("read_at"), to_second(time).alias("shown_at"), *values
    )


def dehydrator_board(current: DataFrame, registry: DataFrame) -> DataFrame:
    """Current scaled values, alarms and average hours; ``current`` has the average, a device without one stays."""
    out = registry.select("ip", "location").join(current, "ip")
    return out.select(
        "ip", "location", "c_life", "c_temp", "c_high",
        from_tenths("c__low").alias("c__low"), from_tenths("c_humi").alias("c_humi"),
        to_second("time").alias("c_time"),
        *[F.col(a) for a in ("a_summ", "a_exrt", "a_high", "a__low", "a_humi", "a_faul")], "average",
        flag_class("a_summ").alias("object_class"), flag_class("a_exrt").alias("life_class"),
        flag_class("a_high").alias("high_class"), flag_class("a__low").alias("low_class"),
        flag_class("a_humi").alias("humidity_class"), flag_class("a_faul").alias("fault_class"),
        F.when(F.coalesce(~F.col("a_faul"), F.lit(False)), "OK").otherwise("NO").alias("fault_word"),
        metric_band(F.col("average") * 100, "hours_per_day").alias("average_class"),
        metric_band("c_temp", "dehydrator_temp").alias("temp_class"),
    )


def action_history(actions: DataFrame, key, order: str, n: int = 8, tie: str | None = None) -> DataFrame:
    """The newest actions per controller, newest first."""
    return last_n(actions, key, order, n, tie)

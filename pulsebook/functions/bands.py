"""Threshold classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsebook.functions.timecols import col
from pulsebook.functions.values import whole_part

GREEN, YELLOW, RED, BLUE = "green", "yellow", "red", "blue"
ON, OFF = "ON", "OFF"

# Metric, y_min, y_max, r_min, r_max.
BANDS = {
    "temp_akb": (15, 27, 5, 35),
    "temp_sys": (20, 40, 15, 45),
    "battery": (53, 55, 47, 60),
    "hours_per_day": (14, 26, 5, 45),
    "dehydrator_temp": (15, 27, 5, 35),
}


def bands_frame(spark: SparkSession) -> DataFrame:
    """The band table: one row per metric, a handful of rows."""
    rows = [(m, *b) for m, b in BANDS.items()]
    return spark.createDataFrame(rows, "metric string, y_min int, y_max int, r_min int, r_max int")


def band_of(value: Column | str, y_min, y_max, r_min, r_max, null_as_zero: bool = False) -> Column:
    """Class of the integer part: outside the r range red, outside the y range yellow."""
    v = whole_part(value)
    if null_as_zero:
        v = F.coalesce(v, F.lit(0))
    bounds = [b if isinstance(b, Column) else F.lit(b) for b in (y_min, y_max, r_min, r_max)]
    return (
        F.when((v < bounds[2]) | (v > bounds[3]), RED)
        .when((v < bounds[0]) | (v > bounds[1]), YELLOW)
        .when(v.isNotNull(), GREEN)
    )


def metric_band(value: Column | str, metric: str, null_as_zero: bool = False) -> Column:
    """Class of one known metric; the band is a literal, so no join is needed."""
    return band_of(value, *BANDS[metric], null_as_zero=null_as_zero)


def band(df: DataFrame, value: str, bands: DataFrame, metric: str = "metric", out: str = "band") -> DataFrame:
    """Class of a long-form reading (metric, value) by a table of bands."""
    b = bands.withColumnRenamed("metric", metric)
    joined = df.join(b, metric, "left")
    return joined.withColumn(
        out, band_of(value, F.col("y_min"), F.col("y_max"), F.col("r_min"), F.col("r_max"))
    ).drop("y_min", "y_max", "r_min", "r_max")


def critical(df: DataFrame, *classes: str) -> DataFrame:
    """Rows with any red class among the named class columns."""
    hit = F.lit(False)
    for c in classes or ("band",):
        hit = hit | (F.col(c) == RED)
    return df.filter(hit)


def site_band(value: Column | str, blue: Column | str, yellow: Column | str, red: Column | str) -> Column:
    """Per-site thresholds, the hottest matching one wins."""
    v = col(value)
    return (
        F.when(v >= col(red), RED)
        .when(v >= col(yellow), YELLOW)
        .when(v <= col(blue), BLUE)
        .when(v.isNotNull(), GREEN)
    )


def flag_class(flag: Column | str, true: str = RED, false: str = GREEN) -> Column:
    """Two-state class; an unknown flag counts as true."""
    return F.when(F.coalesce(~col(flag), F.lit(False)), false).otherwise(true)


def room_class(temp: Column | str, on: int = 26, off: int = 22) -> Column:
    """Room class, bounds included: hot red, cool green, between yellow."""
    t = col(temp)
    return F.when(t >= on, RED).when(t <= off, GREEN).when(t.isNotNull(), YELLOW)


def switch_class(state: Column | str, on_value: str = ON, on_class: str = GREEN, off_class: str = "gray") -> Column:
    return F.when(F.coalesce(col(state) == on_value, F.lit(False)), on_class).otherwise(off_class)

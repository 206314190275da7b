"""Values from device replies held as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsebook.functions.values import alarm_raised, nth_field, tenths

ESCAPE = "\x1b"

# The word that marks each measure's line in a reply and the form of its value.
MEASURES = {
    "c_life": ("life:", r"life:\s+(\d+)"),
    "c_temp": ("temp", r"=\s*(-?[\d.]+)\s*C"),
    "c_high": ("high pressure", r"=\s*(-?[\d.]+)"),
    "c__low": ("low pressure", r"=\s*(-?[\d.]+)"),
    "c_humi": ("humidity", r"=\s*(-?[\d.]+)\s*%"),
}
# The words that mark each alarm's line.
ALARMS = {
    "a_summ": "SUMMARY",
    "a_exrt": "EXCESSIVE RUN",
    "a_high": "HIGH PRESSURE",
    "a__low": "LOW PRESSURE",
    "a_humi": "HIGH HUMIDITY",
    "a_faul": "COMPR FAULT",
}
IN_TENTHS = {"c__low", "c_humi"}
SENSOR_OFFSET = -1
PAGE_TEMPERATURE = r'\{"temperature":\{"air":\{"C":(-?[0-9]+)'


def line_with(lines: str, word: str) -> Column:
    """First line holding the word, null when none does."""
    return F.get(F.filter(lines, lambda line: line.contains(word)), F.lit(0))


def extract_dehydrator(df: DataFrame, text: str = "reply") -> DataFrame:
    """Five measures and six alarms of a reply; rows without hours are left out.

    The reply is cut into lines once, so that patterns run over one short line and not
    the reply. An alarm without its line counts as raised.
    """
    lines = df.withColumn("_lines", F.split(F.replace(F.col(text), F.lit(ESCAPE), F.lit("\n")), "\n"))
    found = {}
    for name, (word, form) in MEASURES.items():
        number = F.regexp_extract(line_with("_lines", word), form, 1).try_cast("decimal(10,3)")
        found[name] = tenths(number) if name in IN_TENTHS else F.round(number).cast("smallint")
    for name, word in ALARMS.items():
        found[name] = alarm_raised(F.substring_index(line_with("_lines", word), "=", -1))
    return lines.withColumns(found).filter(F.col("c_life").isNotNull()).drop("_lines")


def extract_snmp(df: DataFrame, key: list[str], metric: str, line: str, metrics: list[str]) -> DataFrame:
    """One row per poll from one line per metric: the value is the fourth word.

    A poll that lacks a value for any metric is lost whole.
    """
    value = nth_field(line, " ", 4).try_cast("int")
    wide = df.groupBy(*key).agg(
        *[F.max(F.when(F.col(metric) == m, value)).alias(m) for m in metrics]
    )
    return wide.dropna(subset=metrics)


def extract_weather(df: DataFrame, text: str = "html", out: str = "temperature") -> DataFrame:
    """Outdoor temperature of a page, cut to whole degrees; pages without one give no row."""
    value = F.regexp_extract(text, PAGE_TEMPERATURE, 1).try_cast("int")
    return df.withColumn(out, value).filter(F.col(out).isNotNull())


def extract_sensor(df: DataFrame, text: str = "reply", out: str = "temperature") -> DataFrame:
    """Number with one decimal; a failure text gives null."""
    number = F.regexp_extract(text, r"^\s*(-?\d+\.\d)\s*$", 1)
    return df.withColumn(out, number.try_cast("decimal(5,1)"))


def extract_room_sensor(df: DataFrame, text: str = "reply", out: str = "temperature") -> DataFrame:
    """Third word of a ``Temp`` line, with the sensor's offset; other replies give no row."""
    hit = df.filter(F.col(text).contains("Temp"))
    words = F.split(F.trim(text), r"\s+")
    return hit.withColumn(out, F.get(words, F.lit(2)).try_cast("int") + SENSOR_OFFSET).filter(F.col(out).isNotNull())


def extract_ping(df: DataFrame, text: str = "reply", out: str = "received") -> DataFrame:
    return df.withColumn(out, F.coalesce(F.col(text).contains("1 received"), F.lit(False)))

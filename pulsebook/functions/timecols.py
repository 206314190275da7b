"""Column helpers for naive timestamps that do not depend on the session zone."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

HOT_DAYS = 31
DAY_US = 86_400_000_000


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(moment: datetime) -> Column:
    """A naive timestamp literal, foldable so that it reaches the scan."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def epoch_us(t: Column | str) -> Column:
    """Microseconds since 1970 of a naive timestamp.

    Put together from its fields: differences of timestamps would be taken in the
    session zone and stumble over its clock changes.
    """
    c = col(t)
    second_us = (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
    minutes = F.hour(c) * 60 + F.minute(c)
    return F.unix_date(c.cast("date")) * F.lit(DAY_US) + minutes * F.lit(60_000_000).cast("bigint") + second_us


def elapsed_us(start: Column | str, end: Column | str) -> Column:
    return epoch_us(end) - epoch_us(start)


def to_second(t: Column | str) -> Column:
    """Cut to whole seconds; ``date_trunc`` would turn a naive time into a zoned one."""
    return F.timestamp_add("MICROSECOND", -F.pmod(epoch_us(t), F.lit(1_000_000)), col(t))


def to_day(t: Column | str) -> Column:
    return col(t).cast("date").cast("timestamp_ntz")


def recent(t: Column | str, as_of: datetime, days: int = HOT_DAYS) -> Column:
    """Age at most ``days``: a plain bound on the column, so files can be skipped."""
    return col(t) >= ntz(as_of - timedelta(days=days))


def day_window(t: Column | str, as_of: datetime) -> Column:
    """From yesterday's midnight up to ``as_of``, both ends included."""
    start = datetime(as_of.year, as_of.month, as_of.day) - timedelta(days=1)
    return col(t).between(ntz(start), ntz(as_of))


def same_day(t: Column | str, day: date) -> Column:
    start = datetime(day.year, day.month, day.day)
    return (col(t) >= ntz(start)) & (col(t) < ntz(start + timedelta(days=1)))


def day_hour(t: Column | str, day: date, hour: int) -> Column:
    return same_day(t, day) & (F.hour(col(t)) == hour)


def _iso(t: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text; the cast of a naive time knows no zone."""
    return F.rpad(F.substring(col(t).cast("string"), 1, 19), 19, " ")


def dotted_date(t: Column | str, short: bool = False) -> Column:
    iso = _iso(t)
    year = F.substring(iso, 3, 2) if short else F.substring(iso, 1, 4)
    return F.concat_ws(".", F.substring(iso, 9, 2), F.substring(iso, 6, 2), year)


def dashed_date(t: Column | str) -> Column:
    return F.substring(_iso(t), 1, 10)


def clock(t: Column | str) -> Column:
    return F.substring(_iso(t), 12, 8)


def file_day(d: Column | str) -> Column:
    """Day as daily log files are named, ``yyMMdd``."""
    iso = _iso(d)
    return F.concat(F.substring(iso, 3, 2), F.substring(iso, 6, 2), F.substring(iso, 9, 2))


def stamp(t: Column | str) -> Column:
    return F.translate(_iso(t), " ", "_")


def parse_dotted(text: Column | str) -> Column:
    """``dd.MM.yy HH:mm:ss`` as a naive timestamp; null where it is none."""
    iso = F.regexp_replace(col(text), r"^(\d\d)\.(\d\d)\.(\d\d) ", "20$3-$2-$1 ")
    return iso.try_cast("timestamp_ntz")


def parse_stamp(text: Column | str) -> Column:
    """``yyyy-MM-dd_HH:mm:ss`` as a naive timestamp; null where it is none."""
    return F.translate(col(text), "_", " ").try_cast("timestamp_ntz")


def parse_file_day(text: Column | str) -> Column:
    """``yyMMdd`` as a date; null where it is none."""
    return F.regexp_replace(col(text), r"^(\d\d)(\d\d)(\d\d)$", "20$1-$2-$3").try_cast("date")

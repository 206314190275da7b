"""Column helpers for readings, states and texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsebook.functions.timecols import col

# State words, event words and their classes as shown on the boards.
PING_OK = "PING_OK"
PING_NO = "PING_NO"
NO_VALUE = "NULL"
LOST_WORD = "пропал"
FOUND_WORD = "восстановился"
LOST_CLASS = "red_log"
FOUND_CLASS = "green_log"
MAINS_PRESENT = "Есть 380"
MAINS_ABSENT = "Нет  380"


def ip_key(ip: Column | str) -> Column:
    """IPv4 text as a number, so that .9 sorts before .10 with a plain long key."""
    parts = F.split(col(ip), "[.]")
    total = F.lit(0).cast("bigint")
    for i in range(4):
        total = total * 256 + parts[i].cast("bigint")
    return total


def state_word(state: Column | str) -> Column:
    s = col(state)
    return F.when(s, PING_OK).when(~s, PING_NO).otherwise(NO_VALUE)


def text_or_null_word(text: Column | str) -> Column:
    return F.coalesce(F.nullif(col(text), F.lit("")), F.lit(NO_VALUE))


def event_word(state: Column | str) -> Column:
    s = col(state)
    return F.when(~s, LOST_WORD).when(s, FOUND_WORD)


def event_class(state: Column | str) -> Column:
    s = col(state)
    return F.when(~s, LOST_CLASS).when(s, FOUND_CLASS)


def mains_word(code: Column | str) -> Column:
    """0 present, 1 absent, any other code unknown."""
    c = col(code)
    return F.when(c == 0, MAINS_PRESENT).when(c == 1, MAINS_ABSENT)


def alarm_raised(reply: Column | str) -> Column:
    """An alarm is clear only when its reply says OK; a missing reply counts as raised."""
    return ~F.coalesce(col(reply).contains("OK"), F.lit(False))


def differs(a: Column | str, b: Column | str) -> Column:
    """Null-safe inequality."""
    return ~col(a).eqNullSafe(col(b))


def any_differs(pairs: list[tuple[Column, Column]]) -> Column:
    """Plain inequality over several pairs; a null on either side never counts."""
    out = F.lit(False)
    for a, b in pairs:
        out = out | F.coalesce(a != b, F.lit(False))
    return out


def within(a: Column | str, b: Column | str, k: float, inclusive: bool = False) -> Column:
    gap = F.abs(col(a) - col(b))
    return gap <= k if inclusive else gap < k


def corrected(temp: Column | str, correction: Column | str) -> Column:
    """Reading plus calibration, stored as a whole number (half away from zero)."""
    return F.round(col(temp) + col(correction)).cast("int")


def corrected_text(temp: Column | str, correction: Column | str, kind: Column | str) -> Column:
    """Calibrated reading as text with one decimal; sensor kind 11 drops ``.0``."""
    text = (col(temp) + col(correction)).cast("decimal(10,1)").cast("string")
    return F.when(col(kind) == 11, F.replace(text, F.lit(".0"), F.lit(""))).otherwise(text)


def tenths(x: Column | str) -> Column:
    """Scale up by ten to a small integer, rounding half away from zero."""
    return F.round(col(x) * 10).cast("smallint")


def from_tenths(x: Column | str, precision: int = 4) -> Column:
    return (col(x) / 10).cast(f"decimal({precision},1)")


def whole_part(text: Column | str) -> Column:
    """Integer part by cutting the text at the point; empty text counts as 0."""
    head = F.split(col(text).cast("string"), "[.]")[0]
    return F.when(head == "", F.lit(0)).otherwise(head.try_cast("int"))


def from_milli(x: Column | str) -> Column:
    return F.floor(col(x) / 1000).cast("int")


def inverse(x: Column | str) -> Column:
    """1/x, null for zero."""
    return F.try_divide(F.lit(1.0), col(x))


def nth_field(text: Column | str, delimiter: str, n: int) -> Column:
    """n-th delimited field counted from 1, null when there are fewer."""
    quoted = "".join(f"[{c}]" if c in "|.*+?()$" else c for c in delimiter)
    return F.get(F.split(col(text), quoted), F.lit(n - 1))


def without_spaces(text: Column | str) -> Column:
    return F.translate(col(text), " ", "")


def spaces_joined(text: Column | str) -> Column:
    return F.translate(col(text), " ", "_")


def is_comment(line: Column | str) -> Column:
    return col(line).startswith("#") | col(line).startswith("//")

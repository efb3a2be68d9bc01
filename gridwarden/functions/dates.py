"""Timestamps and dates from text; unreadable values become null."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import require_utc


# Fixed value: text that begins with a whole date. Spark alone would read "12:30" as today, "2026-1" as a
# day and, for dates, ignore whatever follows the day.
WHOLE_DATE = r"^\s*\d{4,6}-\d{1,2}-\d{1,2}\s*$|^\s*\d{4,6}-\d{1,2}-\d{1,2}[ T]\s*\d"


def _iso(text: Column) -> Column:
    """ISO text as a timestamp; null unless it has a whole date and nothing unreadable after it."""
    return F.when(text.rlike(WHOLE_DATE), text.try_cast("timestamp"))


DAY = re.compile(r"(\d{4})([-/. ]?)(\d{1,2})\2(\d{1,2})|(\d{1,2})([-/. ])(\d{1,2})\6(\d{4})|(\d{1,2})([-/. ])([A-Za-z]{3})\10(\d{4})")
CLOCK = re.compile(r"([T ])(\d{1,2}):\d{2}(:\d{2})?(\.\d{1,9})?( ?[AaPp][Mm])?( ?(?:Z|[+-]\d{2}:\d{2}|[+-]\d{4}))?")


def format_of(text: str) -> str | None:
    """The pattern that a date or time is written in, or None.

    Of two numbers before a year the first is the month unless it is over 12, whatever stands
    between them. A time of day may follow, with seconds, fractions, AM or PM, and an offset.
    """
    text = text.strip()
    day = DAY.match(text)
    if not day:
        return None
    if day[1]:
        if not day[2] and len(day[3] + day[4]) != 4:
            return None
        out = f"yyyy{day[2]}M{day[2]}d" if day[2] else "yyyyMMdd"
    elif day[5]:
        first, second = ("d", "M") if int(day[5]) > 12 else ("M", "d")
        out = f"{first}{day[6]}{second}{day[6]}yyyy"
    else:
        out = f"d{day[10]}MMM{day[10]}yyyy"
    rest = text[day.end() :]
    if not rest:
        return out
    clock = CLOCK.fullmatch(rest)
    if not clock:
        return None
    out += ("'T'" if clock[1] == "T" else " ") + ("h" if clock[5] else "H") + ":mm" + (":ss" if clock[3] else "")
    out += ".SSSSSSSSS" if clock[4] else ""
    if clock[5]:
        out += (" a" if clock[5].startswith(" ") else "a")
    if clock[6]:
        out += (" " if clock[6].startswith(" ") else "") + ("XXX" if ":" in clock[6] or clock[6].endswith("Z") else "XX")
    return out


def first_format(df: DataFrame, name: str, order: Sequence[str]) -> str | None:
    """The format of the column's first value that isn't null or blank, by the ``order`` columns: one
    aggregation, whose single row reaches the driver. None if it has no format or isn't text."""
    if not isinstance(df.schema[name].dataType, T.StringType):
        return None
    text = F.col(f"`{name}`")
    first = df.where(F.trim(text) != "").agg(F.min_by(text, F.struct(*[F.col(f"`{c}`") for c in order]))).first()[0]
    return None if first is None else format_of(first)


def _strict(text: Column, pattern: str) -> Column:
    return F.try_to_timestamp(F.trim(text), F.lit(pattern))


def to_utc(df: DataFrame, name: str, formats: Sequence[str] = (), only: str | None = None) -> Column:
    """The column as a UTC timestamp. Text is read as ISO with a whole date first, then by each of
    ``formats``; or, if ``only`` names a format, by that alone."""
    require_utc(df)
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp")
    text = c.cast("string")
    if only:
        return _strict(text, only)
    return F.coalesce(_iso(text), *[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def to_day(df: DataFrame, name: str, formats: Sequence[str] = (), only: str | None = None) -> Column:
    """The calendar day as written; a time of day or an offset after it does not move it, and
    anything else after it makes it unreadable. ``formats`` and ``only``: see ``to_utc``."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("date")
    text = c.cast("string")
    if only:  # the day stands before the time of day, so both of its parts must be readable
        written = F.substring_index(F.translate(F.trim(text), "T", " "), " ", _day_words(only))
        return F.when(_strict(text, only).isNotNull(), _strict(written, _day_pattern(only)).cast("date"))
    return F.coalesce(
        F.when(_iso(text).isNotNull(), text.try_cast("date")),
        *[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats],
    )


def _day_pattern(pattern: str) -> str:
    return re.split(r"'T'| [Hh]:", pattern)[0]


def _day_words(pattern: str) -> int:
    return _day_pattern(pattern).count(" ") + 1


def day_text(df: DataFrame, name: str, formats: Sequence[str] = (), only: str | None = None) -> Column:
    return to_day(df, name, formats, only).cast("string")

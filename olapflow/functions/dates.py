"""Calendar, time-zone and duration columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """Date, or text ``yyyy-MM-dd``, to the integer key yyyyMMdd."""
    day = F.to_date(day)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def key_date(key: Column) -> Column:
    """Integer key yyyyMMdd back to a date; null when it names no day."""
    return F.try_to_date(key.cast("string"), "yyyyMMdd")


def date_key_offset(day: Column, days: int) -> Column:
    """Key of the day ``days`` after (or, when negative, before) ``day``."""
    return date_key(F.date_add(F.to_date(day), days))


def calendar_fields(day: Column) -> dict[str, Column]:
    """Key, caption and order columns of every calendar level.

    ISO weeks use ``iso_year * 100 + week``, which sorts and compares as a number.
    """
    iso_year = F.extract(F.lit("YEAROFWEEK"), day)
    iso_week = F.extract(F.lit("WEEK"), day)
    return {
        "date_key": date_key(day),
        "the_year": F.year(day),
        "the_quarter": F.quarter(day),
        "the_month": F.month(day),
        "the_day": F.dayofmonth(day),
        "quarter_key": F.year(day) * 10 + F.quarter(day),
        "month_key": F.year(day) * 100 + F.month(day),
        "quarter_caption": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
        "month_caption": F.date_format(day, "MMM"),
        "day_caption": F.date_format(day, "EEE"),
        "iso_year": iso_year,
        "iso_week": iso_week,
        "iso_day": F.weekday(day) + 1,
        "iso_week_key": iso_year * 100 + iso_week,
        "is_working_day": (F.weekday(day) < 5).cast("int"),
    }


def days_between(start: Column, end: Column) -> Column:
    """Whole calendar days from ``start`` to ``end``; clock changes do not matter."""
    return F.datediff(end, start)


def fractional_days_between(start: Column, end: Column) -> Column:
    """Elapsed time in days, with fractions."""
    return F.timestamp_diff("SECOND", start, end) / F.lit(86400.0)


def add_days(day: Column, n: Column) -> Column:
    return F.date_add(day, n)


def parse_ts(text: Column, pattern: str, zone: str | None = None) -> Column:
    """Text to a UTC wall-clock timestamp.

    A zone inside the text is honoured by the pattern; otherwise ``zone`` names the
    zone of the text. Unreadable text gives null. The session runs in UTC.
    """
    at = F.try_to_timestamp(text, F.lit(pattern))
    return at if zone is None else F.to_utc_timestamp(at, zone)


def to_zone(ts: Column, zone: str) -> Column:
    """UTC timestamp to the wall clock of ``zone``."""
    return F.from_utc_timestamp(ts, zone)


def parse_long_ts(text: Column) -> Column:
    """Epoch milliseconds of ``EEE MMM dd HH:mm:ss Z yyyy``; the weekday is not read."""
    at = F.try_to_timestamp(F.substring(text, 5, 26), F.lit("MMM dd HH:mm:ss Z yyyy"))
    return F.unix_millis(at)


def to_epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970-01-01 of a zoneless timestamp read as UTC."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def from_epoch_seconds(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def format_duration(seconds: Column) -> Column:
    """``1w 2d 3h 4min 5sec`` with zero parts left out; ``0sec`` for nothing."""
    whole = F.floor(seconds).cast("bigint")
    # unit label, its length in seconds, and how many fit in the next larger unit
    units = [("w", 604800, None), ("d", 86400, 7), ("h", 3600, 24), ("min", 60, 60), ("sec", 1, 60)]
    parts = []
    for label, length, wrap in units:
        n = F.floor(whole / F.lit(length))
        n = n if wrap is None else F.pmod(n, F.lit(wrap))
        parts.append(F.when(n != 0, F.concat(n.cast("string"), F.lit(label))))
    text = F.concat_ws(" ", *parts)
    return F.when(whole.isNull(), None).when(text == "", F.lit("0sec")).otherwise(text)

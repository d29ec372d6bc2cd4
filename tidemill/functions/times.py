"""Dates, numbers and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def valid_date(text: Column) -> Column:
    """YYYY-MM-DD of a day that exists, else null."""
    return F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.try_to_date(text, "yyyy-MM-dd").isNotNull(), text)


def day_shape(text: Column) -> Column:
    """YYYY-MM-DD by shape alone."""
    return F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), text)


def compact_day(text: Column) -> Column:
    """Eight digits as YYYY-MM-DD of a day that exists."""
    return F.date_format(F.when(text.rlike("^[0-9]{8}$"), F.try_to_date(text, "yyyyMMdd")), "yyyy-MM-dd")


def day_part(text: Column) -> Column:
    return F.left(text, F.lit(10))


def epoch_ms(text: Column) -> Column:
    """A count of milliseconds in digits, else null."""
    return F.when(text.cast("string").rlike("^[0-9]{1,18}$"), text.try_cast("long"))


def iso_ms(text: Column) -> Column:
    """Milliseconds of an ISO time, UTC where it names no zone; a bare day is its midnight."""
    return F.unix_millis(F.try_to_timestamp(text))


def stamp(ms: Column) -> Column:
    """Milliseconds as 13 digits."""
    return F.lpad(ms.cast("string"), 13, "0")


def iso(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def day_of(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd")


def from_day(day: Column) -> Column:
    """Milliseconds of a day's midnight."""
    return F.unix_millis(F.to_timestamp(day, "yyyy-MM-dd"))


def clock(ms: Column) -> Column:
    """m:ss, or h:mm:ss from an hour on; ? for null or negative."""
    s = F.floor(ms / 1000).cast("long")
    h, m, r = F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"), s % 60
    shown = F.when(h > 0, F.format_string("%d:%02d:%02d", h, m, r)).otherwise(F.format_string("%d:%02d", m, r))
    return F.when(ms.isNull() | (ms < 0), F.lit("?")).otherwise(shown)


def minutes(seconds: Column) -> Column:
    """mm:ss, or h:mm:ss from an hour on."""
    s = seconds.cast("long")
    h, m, r = F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"), s % 60
    return F.when(h > 0, F.format_string("%d:%02d:%02d", h, m, r)).otherwise(F.format_string("%02d:%02d", m, r))


def duration_of(text: Column, seconds: Column) -> Column:
    """The text if it is shaped as a duration, else that of positive seconds, else null."""
    return F.when(text.rlike("^([0-9]+:)?[0-9]{1,2}:[0-9]{2}$"), text).when(seconds > 0, minutes(seconds))


def feed_seconds(text: Column) -> Column:
    """Seconds of s, m:s or h:m:s; parts that are not digits go; other numbers of parts are null."""
    parts = F.filter(F.split(F.trim(text), ":", -1), lambda p: p.rlike("^[0-9]{1,9}$"))
    n = F.transform(parts, lambda p: p.cast("long"))
    return F.when(F.size(n) == 1, F.get(n, 0)).when(F.size(n) == 2, F.get(n, 0) * 60 + F.get(n, 1)).when(F.size(n) == 3, F.get(n, 0) * 3600 + F.get(n, 1) * 60 + F.get(n, 2))


def count_of(n: Column) -> Column:
    return F.when(n >= 0, n)


def backoff(asked: Column) -> Column:
    """Seconds to wait: what is asked plus one, 1 to 300; 60 is taken where nothing is asked."""
    return F.least(F.greatest(F.coalesce(asked, F.lit(60)) + 1, F.lit(1)), F.lit(300))


def inner_deadline(seconds: Column) -> Column:
    return F.greatest(seconds - 10, F.lit(1))

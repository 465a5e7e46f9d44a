"""Scalar column helpers: time, defaults, splitting, substring tests."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, functions as F, types as T

# Date, then optionally any one character, a time and an offset; all but the date in extended or basic form.
_ISO = (
    r"(?s)^(\d{4}-\d{2}-\d{2}|\d{8}|\d{4}-W\d{2}-\d|\d{4}-W\d{2}|\d{4}W\d{3}|\d{4}W\d{2})"
    r"(?:.(\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?)?|\d{2}(?:\d{2}(?:\d{2}(?:[.,]\d+)?)?)?)"
    r"(Z|[+-]\d{2}(?::\d{2}(?::\d{2})?|\d{2}(?:\d{2})?)?)?)?$"
)


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds (fractions allowed) as a UTC instant."""
    return F.timestamp_seconds(seconds)


def iso_to_timestamp(text: Column) -> Column:
    """ISO-8601 text as a timestamp; null where the text is not a date.

    Read are calendar dates and week dates (a week alone means its Monday), in
    extended and basic form, any one character before the time, times down to
    hours, fractions of any length (cut to microseconds), and offsets down to
    seconds.  Text without an offset is taken in the session time zone.
    """
    known = text.rlike(_ISO)
    day, time, offset = (F.regexp_extract(text, _ISO, i) for i in (1, 2, 3))
    digits = F.regexp_replace(day, "[-W]", "")
    year = F.substring(digits, 1, 4).cast("int")
    # Week 1 holds January 4th.
    first = F.date_trunc("week", F.make_date(F.greatest(year, F.lit(1)), F.lit(1), F.lit(4))).cast("date")
    week, weekday = F.substring(digits, 5, 2).cast("int"), F.substring(F.concat(digits, F.lit("1")), 7, 1).cast("int")
    in_week = F.date_add(first, (week - 1) * 7 + weekday - 1)
    real = week.between(1, 53) & weekday.between(1, 7) & (F.weekofyear(in_week) == week)
    calendar = F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2))
    date = F.when(~day.contains("W"), calendar).when(real, in_week.cast("string"))
    clock = F.regexp_replace(F.regexp_replace(time, "[.,].*$", ""), ":", "")
    fraction = F.substring(F.concat(F.regexp_extract(time, "[.,](\\d+)$", 1), F.lit("000000")), 1, 6)
    piece = lambda i: F.substring(F.concat(clock, F.lit("000000")), i, 2)
    whole = F.concat(date, F.lit(" "), F.concat_ws(":", piece(1), piece(3), piece(5)), F.lit("."), fraction)
    shift = F.rpad(F.regexp_replace(F.substring(offset, 2, 8), ":", ""), 6, "0")
    part = lambda i: F.substring(shift, i, 2).cast("int")
    seconds = F.when(offset.startswith("-"), -1).otherwise(1) * (part(1) * 3600 + part(3) * 60 + part(5))
    zoned = F.try_to_timestamp(F.concat(whole, F.lit("Z"))) - F.make_dt_interval(secs=seconds)
    utc = F.try_to_timestamp(F.concat(whole, F.lit("Z")))
    valid = known & (year > 0)
    return (
        F.when(valid & (offset == ""), F.try_to_timestamp(whole))
        .when(valid & (offset == "Z"), utc)
        .when(valid & (part(1) < 24) & (part(3) < 60) & (part(5) < 60), zoned)
    )


def timestamp_to_iso(ts: Column) -> Column:
    """ISO-8601 text; the fraction is written only when it is not zero."""
    whole = F.date_trunc("second", ts) == ts
    return F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )


def time_literal(value: dt.datetime | dt.date | str, like: T.DataType | None = None) -> Column:
    """A timestamp literal of the column's own type, so that filters reach the scan.

    Naive values mean session time; aware ones are converted to UTC.
    """
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    ntz = isinstance(like, T.TimestampNTZType)
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc)
        if ntz:
            value = value.replace(tzinfo=None)
    text = value.isoformat(sep=" ", timespec="microseconds")
    return F.lit(text).cast("timestamp_ntz" if ntz else "timestamp")


def epoch_seconds(ts: Column) -> Column:
    """Seconds since the epoch as a double, for zoned and unzoned timestamps."""
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1_000_000.0)


def or_default(value: Column, default: str) -> Column:
    """``default`` where the text is null or empty."""
    return F.when(value.isNull() | (value == ""), F.lit(default)).otherwise(value)


def part(text: Column, separator: str, index: int) -> Column:
    """One piece of a split; null when there are too few pieces."""
    return F.get(F.split(text, separator), index)


def contains_any(text: Column, keywords: Iterable[str]) -> Column:
    """Whether the lower-cased text holds any keyword as a substring."""
    lowered = F.lower(text)
    hit = F.lit(False)
    for keyword in keywords:
        hit = hit | F.contains(lowered, F.lit(keyword))
    return hit


def preview(text: Column, length: int = 100) -> Column:
    """The first ``length`` characters."""
    return F.substring(text, 1, length)

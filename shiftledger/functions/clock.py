"""Dates, times of day and durations as native column expressions.

Every timestamp here is ``timestamp_ntz`` (wall clock), so no result depends on
``spark.sql.session.timeZone``; the readers convert instants or refuse them.  ``date_format``, ``date_trunc`` and
``timestampdiff`` are avoided for that reason: they cast a wall-clock timestamp
to an instant in the session zone first.
"""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from shiftledger.functions.zones import Zone, to_instant

MINUTES_PER_DAY = 24 * 60
MICROSECONDS_PER_HOUR = 3.6e9


def as_day(value: date | str) -> date:
    if isinstance(value, datetime):
        return value.date()
    return value if isinstance(value, date) else date.fromisoformat(value)


def day_literal(value: date | str) -> Column:
    return F.lit(as_day(value).isoformat()).cast("date")


def timestamp_literal(value: datetime | str) -> Column:
    moment = value if isinstance(value, datetime) else datetime.fromisoformat(value)
    if moment.tzinfo is not None:
        raise ValueError(f"expected a wall-clock time without an offset, got {value}")
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def clock_to_minutes(text: str) -> int:
    """``'06:00'`` -> 360, for limits given by the caller."""
    hours, minutes = text.split(":")
    return int(hours) * 60 + int(minutes)


def time_interval(text: str) -> Column:
    """``'22:59:59'`` as a day-time interval literal."""
    if not re.fullmatch(r"\d{1,2}:\d{2}:\d{2}", text):
        raise ValueError(f"expected HH:MM:SS, got {text!r}")
    return F.expr(f"INTERVAL '{text}' HOUR TO SECOND")


def calendar_day(ts: Column) -> Column:
    return ts.cast("date")


def day_start(ts: Column) -> Column:
    return calendar_day(ts).cast("timestamp_ntz")


def minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def _two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def minutes_text(minutes: Column) -> Column:
    """Minutes as zero-padded ``HH:MM``."""
    hours = F.floor(minutes / 60)
    return F.concat(_two_digits(hours), F.lit(":"), _two_digits(minutes % 60))


def time_of_day(ts: Column) -> Column:
    """Zero-padded ``HH:MM``; seconds are cut, not rounded."""
    return F.concat(_two_digits(F.hour(ts)), F.lit(":"), _two_digits(F.minute(ts)))


def text_to_minutes(text: Column) -> Column:
    """``HH:MM`` text to minutes; null where the text is not two numbers."""
    parts = F.split(text, ":")
    return F.get(parts, F.lit(0)).try_cast("int") * 60 + F.get(parts, F.lit(1)).try_cast("int")


def elapsed(start: Column, stop: Column, zone: str | Zone | None = None) -> Column:
    """``stop - start`` as an interval: wall clock, or absolute time in ``zone``."""
    if zone is not None:
        start, stop = to_instant(start, zone), to_instant(stop, zone)
    return stop - start


def duration_text(start: Column, stop: Column, zone: str | Zone | None = None) -> Column:
    """Unpadded ``H:M`` of ``stop - start``; seconds and whole days are dropped."""
    span = elapsed(start, stop, zone)
    return F.concat(
        F.extract(F.lit("HOUR"), span).cast("string"),
        F.lit(":"),
        F.extract(F.lit("MINUTE"), span).cast("string"),
    )


def duration_hours(start: Column, stop: Column, zone: str | Zone | None = None) -> Column:
    """``stop - start`` in hours, rounded once, from whole microseconds."""
    seconds = elapsed(start, stop, zone).cast("interval second").cast("decimal(18,6)")
    return (seconds * 1_000_000).cast("long") / MICROSECONDS_PER_HOUR


def worked_minutes(start_minute: Column, stop_minute: Column) -> Column:
    """Minutes from start to stop; a stop before the start is on the next day."""
    return F.pmod(stop_minute - start_minute, F.lit(MINUTES_PER_DAY))

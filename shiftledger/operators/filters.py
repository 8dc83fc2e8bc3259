"""Row filters on the two fact tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger.functions.clock import (
    calendar_day,
    day_literal,
    day_start,
    time_interval,
)

#: What the readers call a partition column that equals the calendar day.
PARTITION_DAY = "__partition_day"


def in_day_range(
    df: DataFrame, ts: str, from_day: date | str, to_day: date | str
) -> DataFrame:
    """Rows whose calendar day is in the range, both ends included.

    Catalyst turns the day comparison into a timestamp range that reaches the
    scan.  A partition column that the reader was told of is restricted as well;
    rows without a value there are read.
    """
    low, high = day_literal(from_day), day_literal(to_day)
    kept = df.filter(calendar_day(F.col(ts)).between(low, high))
    if PARTITION_DAY in df.columns:
        partition = F.col(PARTITION_DAY)
        kept = kept.filter(partition.isNull() | partition.between(low, high)).drop(PARTITION_DAY)
    return kept


def has_flag(flags: Column, bit: int) -> Column:
    return flags.bitwiseAND(bit) == bit


def before_cutoff(ts: Column, cutoff: str) -> Column:
    """Time of day no later than the cutoff; fractions after it are late."""
    return ts <= day_start(ts) + time_interval(cutoff)


def in_event_window(
    events: DataFrame, from_day: date | str, to_day: date | str, cutoff: str
) -> DataFrame:
    """Clock events of the days, each day only up to the cutoff."""
    return in_day_range(events, "event_ts", from_day, to_day).filter(
        before_cutoff(F.col("event_ts"), cutoff)
    )


def of_types(event_type: Column, types: tuple[int, ...]) -> Column:
    return event_type.isin(*types)

"""Offset changes of a zone as a sorted table, searched per timestamp.

An hour, or half an hour, that a clock shows twice is read as its first or its
second pass.  A time that the clock skips is read with the offset before the
change, that is as if the clock had gone on.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

FIRST, SECOND = "first", "second"
#: Changes are listed up to this year; later times have the offset of its last one.
LAST_YEAR = 2200


@dataclass(frozen=True)
class Zone:
    """A zone by its name, and which pass a repeated time is."""

    name: str
    repeated: str = SECOND

    def __post_init__(self) -> None:
        if self.repeated not in (FIRST, SECOND):
            raise ValueError(f"a repeated time is its {FIRST} or {SECOND} pass, not {self.repeated!r}")


def as_zone(zone: str | Zone) -> Zone:
    return zone if isinstance(zone, Zone) else Zone(zone)


@lru_cache
def _changes(name: str) -> tuple[int, list[tuple[int, int, int]]]:
    """The first offset of a zone, and its changes: instant, offset before and after, all in seconds."""
    jvm = SparkSession.active()._jvm
    rules = jvm.java.time.ZoneId.of(name).getRules()
    end = jvm.java.time.Instant.parse(f"{LAST_YEAR}-12-31T00:00:00Z")
    at = jvm.java.time.Instant.MIN
    first = rules.getOffset(at).getTotalSeconds()
    found = []
    while (change := rules.nextTransition(at)) is not None:
        at = change.getInstant()
        if at.compareTo(end) > 0:
            break
        before, after = change.getOffsetBefore(), change.getOffsetAfter()
        found.append((at.getEpochSecond(), before.getTotalSeconds(), after.getTotalSeconds()))
    return first, found


def _wall_seconds(ts: Column) -> Column:
    """Seconds of a wall clock since 1970 on that clock, as a decimal."""
    since = ts - F.lit("1970-01-01").cast("timestamp_ntz")
    return since.cast("interval second").cast("decimal(18,6)")


def offset_at(ts: Column, zone: str | Zone) -> Column:
    """Seconds that the wall clock ``ts`` of the zone is ahead of UTC."""
    zone = as_zone(zone)
    first, changes = _changes(zone.name)
    if not changes:
        return F.lit(first)
    # when the wall clock is past a change: a skipped time never is, a repeated one in its second pass
    later = [
        at + (min(before, after) if zone.repeated == SECOND and before > after else max(before, after))
        for at, before, after in changes
    ]
    starts = F.lit(later).cast("array<bigint>")
    offsets = F.lit([first, *[after for _, _, after in changes]]).cast("array<int>")
    seconds = _wall_seconds(ts)

    def further(place: Column, step: Column) -> Column:
        # a step too far reads null, and stays
        return F.when(F.get(starts, place + step - 1) <= seconds, place + step).otherwise(place)

    steps = [1 << bit for bit in reversed(range(len(later).bit_length()))]
    place = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), further)
    return F.when(ts.isNotNull(), F.get(offsets, place))


def to_instant(ts: Column, zone: str | Zone) -> Column:
    """The wall clock ``ts`` of the zone as the wall clock of UTC."""
    return ts - F.make_dt_interval(secs=offset_at(ts, zone).cast("decimal(18,6)"))

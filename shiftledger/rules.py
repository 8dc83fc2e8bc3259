"""The adjustable rules of a report, with the published values as defaults."""

from __future__ import annotations

from dataclasses import dataclass

from shiftledger.functions.zones import Zone


@dataclass(frozen=True)
class Rules:
    #: Bit of ``work_records.flags`` that makes a record count.
    work_flag: int = 2
    #: Latest time of day of a clock event, inclusive.
    event_cutoff: str = "22:59:59"
    #: Event types that open a listed interval; others only end one.
    listed_types: tuple[int, ...] = (1, 2, 3, 4)
    #: Event types whose interval accrues hours.
    accruing_types: tuple[int, ...] = (1, 3)
    #: Event type of the breakfast break.
    break_type: int = 3
    #: Latest start of a day that passes.
    start_limit: str = "06:00"
    #: Least worked minutes that pass.
    min_minutes: int = 480
    #: Measure durations as absolute time in this zone; None is wall clock.  A
    #: time that occurs twice is its second pass, unless the ``Zone`` says its first.
    zone: str | Zone | None = None
    #: Skip the two dimension joins that add no column.  They can only repeat
    #: detail rows, and only if a dimension key is not unique.
    assume_unique_dimensions: bool = False


DEFAULT_RULES = Rules()

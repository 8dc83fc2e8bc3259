"""The four attendance checks and the verdict."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shiftledger.functions.clock import minutes_text

# The texts written into the published report.
OK = "OK"
TOO_SHORT = "Poniżej 8h"
NO_BREAK = "brak przerwy"
PASSED = "✔️"
FAILED = "❌"


def start_check(start_minute: Column, limit_minute: int) -> Column:
    """OK when the start is no later than the limit, else the start itself."""
    return F.when(start_minute <= limit_minute, OK).otherwise(minutes_text(start_minute))


def end_check(worked: Column, stop_minute: Column, min_minutes: int) -> Column:
    """The stop time when too little was worked; unknown worked time stays null."""
    return F.when(worked >= min_minutes, OK).when(
        worked < min_minutes, minutes_text(stop_minute)
    )


def hours_check(worked: Column, min_minutes: int) -> Column:
    return F.when(worked >= min_minutes, OK).when(worked < min_minutes, TOO_SHORT)


def break_check(break_text: Column) -> Column:
    """OK when a break is recorded, even one of zero minutes."""
    return F.when(F.length(break_text) > 0, OK).otherwise(NO_BREAK)


def verdict(*checks: Column) -> Column:
    """Passed only if every check is OK; an unknown check is not OK."""
    all_ok = reduce(lambda a, b: a & b, [check == OK for check in checks])
    return F.when(all_ok, PASSED).otherwise(FAILED)

"""Work days and event intervals as one relation."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger.functions.clock import duration_hours, timestamp_literal
from shiftledger.functions.text import search_key
from shiftledger.operators.filters import in_event_window, of_types
from shiftledger.operators.successors import drop_repeats, successors
from shiftledger.operators.work_days import work_days
from shiftledger.rules import DEFAULT_RULES, Rules
from shiftledger.sources.tables import Tables

WORK_SOURCE = 0
EVENT_SOURCE = 1


def open_end(next_ts: Column, as_of: datetime | str) -> Column:
    """End of an interval: the next event, or the report time if there is none."""
    return F.coalesce(next_ts, timestamp_literal(as_of))


def event_hours(event_type: Column, start: Column, stop: Column, rules: Rules) -> Column:
    """Hours of the interval for types that accrue them, else zero."""
    return F.when(
        of_types(event_type, rules.accruing_types), duration_hours(start, stop, rules.zone)
    ).otherwise(0.0)


def event_intervals(
    clock_events: DataFrame,
    from_day: date | str,
    to_day: date | str,
    as_of: datetime | str,
    rules: Rules = DEFAULT_RULES,
    **split,
) -> DataFrame:
    """Distinct intervals from each listed event to the employee's next event.

    All event types end an interval, so types are filtered after the successor
    is known.
    """
    window = in_event_window(clock_events, from_day, to_day, rules.event_cutoff)
    followed = successors(window, **split)
    listed = followed.filter(of_types(F.col("event_type"), rules.listed_types))
    start, stop = F.col("event_ts"), open_end(F.col("next_ts"), as_of)
    closed = drop_repeats(listed.withColumn("stop_ts", stop), "event_ts", "stop_ts")
    return closed.select(
        search_key(F.col("employee_id"), F.col("day"), F.col("event_id")).alias("search_key"),
        "employee_id",
        event_hours(F.col("event_type"), start, F.col("stop_ts"), rules).alias("hours"),
        F.lit(0.0).alias("effective_hours"),
        start.alias("start_ts"),
        "stop_ts",
        "day",
        F.col("event_type").alias("action"),
        F.lit(EVENT_SOURCE).alias("source"),
        "event_id",
    )


def work_intervals(
    work_records: DataFrame,
    from_day: date | str,
    to_day: date | str,
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """Work days in the columns of the activity relation."""
    return work_days(work_records, from_day, to_day, rules).select(
        search_key(F.col("employee_id"), F.col("day")).alias("search_key"),
        "employee_id",
        "hours",
        "effective_hours",
        "start_ts",
        "stop_ts",
        "day",
        F.lit(None).cast("int").alias("action"),
        F.lit(WORK_SOURCE).alias("source"),
        F.lit(None).cast("long").alias("event_id"),
    )


def activity(
    tables: Tables,
    from_day: date | str,
    to_day: date | str,
    as_of: datetime | str,
    rules: Rules = DEFAULT_RULES,
    **split,
) -> DataFrame:
    """Distinct union of both branches.

    Each branch is distinct by itself and ``source`` keeps them apart, so the
    union needs no distinct of its own and unused columns can be pruned.
    """
    split.setdefault("split_hot", tables.count_events)
    return work_intervals(tables.work_records, from_day, to_day, rules).unionByName(
        event_intervals(tables.clock_events, from_day, to_day, as_of, rules, **split)
    )

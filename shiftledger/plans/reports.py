"""The two reports."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger.functions import checks
from shiftledger.functions.clock import (
    calendar_day,
    clock_to_minutes,
    duration_text,
    minutes_text,
    time_of_day,
    worked_minutes,
)
from shiftledger.functions.text import full_name
from shiftledger.operators.activity import activity, event_intervals, work_intervals
from shiftledger.operators.filters import has_flag, in_day_range, in_event_window, of_types
from shiftledger.operators.labels import DETAIL_LABELS, SUMMARY_LABELS
from shiftledger.operators.rollup import (
    FACTS,
    MEMBER,
    employee_days,
    person_days,
    spread_login_facts_by_join,
    spread_login_facts_by_window,
    with_facts,
)
from shiftledger.operators.roster import attach_members, enrich
from shiftledger.operators.sizes import has_small_roster
from shiftledger.rules import DEFAULT_RULES, Rules
from shiftledger.sources.tables import Tables


def _full_name() -> Column:
    return full_name(F.col("first_name"), F.col("last_name")).alias("full_name")


def detail_report(
    tables: Tables,
    from_day: date | str,
    to_day: date | str,
    as_of: datetime | str | None = None,
    rules: Rules = DEFAULT_RULES,
    facts: DataFrame | None = None,
    **split,
) -> DataFrame:
    """Work days and event intervals with master data, one row each.

    ``as_of`` ends intervals without a next event (now, if not given); give it
    for a repeatable report, and to both reports to have them agree.  ``facts``
    hands over the activity, so that both reports read it once.
    """
    rows = facts
    if rows is None:
        rows = activity(tables, from_day, to_day, as_of or datetime.now(), rules, **split)
    row_exact = not rules.assume_unique_dimensions
    named = enrich(rows, tables, has_small_roster(tables, row_exact), row_exact)
    start, stop = F.col("start_ts"), F.col("stop_ts")
    computed = {
        "full_name": _full_name(),
        "start_hm": time_of_day(start),
        "stop_hm": time_of_day(stop),
        "duration_hm": duration_text(start, stop, rules.zone),
    }
    return named.select(
        *[computed.get(name, F.col(name)).alias(name) for name in DETAIL_LABELS]
    )


def people(
    tables: Tables,
    from_day: date | str,
    to_day: date | str,
    as_of: datetime | str | None = None,
    rules: Rules = DEFAULT_RULES,
    facts: DataFrame | None = None,
    **split,
) -> DataFrame:
    """Facts of each person-day.

    The activity is reduced to employee-days before any join.
    """
    if facts is not None:
        return person_days(employee_days(facts, rules.break_type), tables.employees)
    split.setdefault("split_hot", tables.count_events)
    worked = with_facts(
        work_intervals(tables.work_records, from_day, to_day, rules), rules.break_type
    )
    intervals = event_intervals(
        tables.clock_events, from_day, to_day, as_of or datetime.now(), rules, **split
    )
    days = worked.unionByName(employee_days(intervals, rules.break_type))
    return person_days(days, tables.employees)


def employee_day_rows(
    tables: Tables, from_day: date | str, to_day: date | str, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Distinct employee attributes per day.

    Which days an employee has does not depend on where intervals end, so no
    window is needed; a repeated row does not matter either, so the joins that
    could only repeat rows are left out.
    """
    worked = in_day_range(tables.work_records, "start_ts", from_day, to_day).filter(
        has_flag(F.col("flags"), rules.work_flag)
    )
    clocked = in_event_window(tables.clock_events, from_day, to_day, rules.event_cutoff).filter(
        of_types(F.col("event_type"), rules.listed_types)
    )
    days = (
        worked.select("employee_id", calendar_day(F.col("start_ts")).alias("day"))
        .union(clocked.select("employee_id", calendar_day(F.col("event_ts")).alias("day")))
        .distinct()
    )
    named = enrich(days, tables, has_small_roster(tables), row_exact=False)
    return named.withColumn("full_name", _full_name()).select(*MEMBER).distinct()


def summary_report(
    tables: Tables,
    from_day: date | str,
    to_day: date | str,
    as_of: datetime | str | None = None,
    rules: Rules = DEFAULT_RULES,
    small_roster: bool | None = None,
    facts: DataFrame | None = None,
    **split,
) -> DataFrame:
    """One row per distinct employee attributes and day, graded.

    Employees who share a login share start, stop and first break.  Attributes
    are attached last; the distinct then needs no shuffle of its own if Spark
    broadcasts them.  A repeated row changes neither distinct rows nor facts, so
    the joins that could only repeat rows are left out.  ``small_roster``
    overrides the size check of the employee tables; ``facts`` hands over the
    activity, as for the detail.
    """
    if small_roster is None:
        small_roster = has_small_roster(tables)
    spread = spread_login_facts_by_window if small_roster else spread_login_facts_by_join
    everyone = spread(people(tables, from_day, to_day, as_of, rules, facts, **split))
    members = (
        attach_members(everyone, tables)
        .withColumn("full_name", _full_name())
        .select(*MEMBER, *FACTS)
        .distinct()
    )

    start, stop, first = F.col("start_minute"), F.col("stop_minute"), F.col("first_break")
    worked = worked_minutes(start, stop)
    break_hm = duration_text(first["start_ts"], first["stop_ts"], rules.zone)
    graded = {
        "start_check": checks.start_check(start, clock_to_minutes(rules.start_limit)),
        "end_check": checks.end_check(worked, stop, rules.min_minutes),
        "hours_check": checks.hours_check(worked, rules.min_minutes),
        "break_check": checks.break_check(break_hm),
    }
    computed = {
        "start_hm": minutes_text(start),
        "stop_hm": minutes_text(stop),
        "worked_hm": minutes_text(worked),
        "break_hm": break_hm,
        "comment": F.lit(None).cast("string"),
        **graded,
        "verdict": checks.verdict(*graded.values()),
    }
    return members.select(
        *[computed.get(name, F.col(name)).alias(name) for name in SUMMARY_LABELS]
    )

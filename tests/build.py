"""Small hand-written tables."""

from __future__ import annotations

from datetime import datetime

from shiftledger.sources.schemas import SCHEMAS
from shiftledger.sources.tables import Tables

DAY = "2024-01-05"


def ts(text: str | None, day: str = DAY) -> datetime | None:
    """``'10:00'`` on the test day, or a full timestamp."""
    if text is None:
        return None
    return datetime.fromisoformat(text if "-" in text else f"{day} {text}")


def work(employee, start, stop, hours=1.0, engagement=100.0, flags=2):
    return (employee, ts(start), ts(stop), hours, engagement, flags)


def event(employee, event_id, event_type, at):
    return (event_id, ts(at), event_type, employee)


def person(employee, login, first="A", last="A", shift=1, department=1, position=1):
    return (employee, login, first, last, shift, department, position)


def make_tables(
    spark,
    works=(),
    events=(),
    employees=(),
    attributes=(),
    departments=((1,),),
    positions=((1,),),
) -> Tables:
    rows = {
        "work_records": works,
        "clock_events": events,
        "employees": employees,
        "departments": departments,
        "employee_attributes": attributes,
        "positions": positions,
    }
    return Tables(
        **{name: spark.createDataFrame(list(rows[name]), SCHEMAS[name]) for name in rows}
    )

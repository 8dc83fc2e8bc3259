"""Roll-ups of the activity: per employee-day, per person-day, per login-day.

Times of day are compared as minutes, which order as their ``HH:MM`` texts do.
Every aggregate merges partial results, so a hot employee or login arrives
pre-aggregated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftledger.functions.clock import minute_of_day
from shiftledger.operators.joins import left_join_null_safe

#: Attributes that tell the rows of the summary apart.
MEMBER = [
    "login",
    "day",
    "full_name",
    "bibi",
    "department",
    "job_function",
    "hc_or_agency",
    "position",
    "shift_id",
]
PERSON_DAY = ["day", "master_id", "login"]
LOGIN_DAY = ["day", "login"]
FACTS = ["start_minute", "stop_minute", "first_break"]


def break_marker(break_type: int) -> Column:
    """Orders breaks by start, then event id; carries start and end."""
    return F.when(
        F.col("action") == break_type, F.struct("start_ts", "event_id", "stop_ts")
    )


def with_facts(activity: DataFrame, break_type: int) -> DataFrame:
    """Start and stop minute of each row, and its break marker if it is one."""
    return activity.select(
        "employee_id",
        "day",
        minute_of_day(F.col("start_ts")).alias("start_minute"),
        minute_of_day(F.col("stop_ts")).alias("stop_minute"),
        break_marker(break_type).alias("first_break"),
    )


def merge_facts(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Earliest start, latest stop time of day and first break per key."""
    return facts.groupBy(*keys).agg(
        F.min("start_minute").alias("start_minute"),
        F.max("stop_minute").alias("stop_minute"),
        F.min("first_break").alias("first_break"),
    )


def employee_days(activity: DataFrame, break_type: int) -> DataFrame:
    return merge_facts(with_facts(activity, break_type), ["employee_id", "day"])


def person_days(days: DataFrame, employees: DataFrame) -> DataFrame:
    """Employee-days by day, master id and login; all unknown employees are one.

    Only the login is attached here, so that what is shuffled next stays narrow.
    """
    logins = employees.select(F.col("employee_id").alias("master_id"), "login")
    return merge_facts(
        days.join(logins, days["employee_id"] == logins["master_id"], "left"), PERSON_DAY
    )


def login_days(people: DataFrame) -> DataFrame:
    """Facts shared by everyone with the same login; null is a login too."""
    return merge_facts(people, LOGIN_DAY)


def spread_login_facts_by_window(people: DataFrame) -> DataFrame:
    """Person-days with the facts of their login in place of their own.

    Puts all employees of a login-day into one task, so it is for employee
    tables whose size is known to be small.
    """
    login_day = Window.partitionBy(*LOGIN_DAY)
    return people.select(
        *PERSON_DAY,
        F.min("start_minute").over(login_day).alias("start_minute"),
        F.max("stop_minute").over(login_day).alias("stop_minute"),
        F.min("first_break").over(login_day).alias("first_break"),
    )


def spread_login_facts_by_join(people: DataFrame) -> DataFrame:
    """The same for employee tables of any size.

    Adaptive execution can split a hot login of a join.  Each person's own facts
    are among those of its login, so taking the better of the two changes
    nothing; it keeps both sides reading the same columns of ``people``, so that
    Spark computes and shuffles them once.
    """
    logins = login_days(people).withColumnsRenamed({name: f"login_{name}" for name in FACTS})
    both = left_join_null_safe(people, logins, LOGIN_DAY)
    return both.select(
        *PERSON_DAY,
        F.least("start_minute", "login_start_minute").alias("start_minute"),
        F.greatest("stop_minute", "login_stop_minute").alias("stop_minute"),
        F.least("first_break", "login_first_break").alias("first_break"),
    )

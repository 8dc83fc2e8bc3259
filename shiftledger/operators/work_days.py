"""Booked work, one row per employee and day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.functions.clock import calendar_day
from shiftledger.operators.filters import has_flag, in_day_range
from shiftledger.rules import DEFAULT_RULES, Rules


def work_days(
    work_records: DataFrame,
    from_day: date | str,
    to_day: date | str,
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """Hours, engagement-weighted hours and span of the flagged records.

    The partial aggregate runs before the shuffle, so an employee-day of any
    size arrives as one row per input partition.
    """
    flagged = in_day_range(work_records, "start_ts", from_day, to_day).filter(
        has_flag(F.col("flags"), rules.work_flag)
    )
    return (
        flagged.withColumn("day", calendar_day(F.col("start_ts")))
        .groupBy("employee_id", "day")
        .agg(
            F.sum("hours").alias("hours"),
            F.sum(F.col("hours") * (F.col("engagement") / 100)).alias("effective_hours"),
            F.min("start_ts").alias("start_ts"),
            F.max("stop_ts").alias("stop_ts"),
        )
    )

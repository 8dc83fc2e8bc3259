"""The six tables derived from the star-schema sample data (whole tables)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftledger.sources.tables import conform

#: event kind -> event type; 5 is a type that only ends intervals
EVENT_TYPES = {"signup": 1, "view": 2, "click": 3, "purchase": 4, "error": 5}

#: Columns read, with their types: given, not inferred, so that a read costs no job.
COLUMNS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
    "l_discount double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int",
    "region": "r_regionkey int",
}


class SampleTables:
    """Stands in for ``Tables``; each table is set up when first used."""

    count_events = True

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark = spark
        self._sf_dir = sf_dir

    def _read(self, name: str) -> DataFrame:
        return self._spark.read.schema(COLUMNS[name]).parquet(f"{self._sf_dir}/{name}.parquet")

    @cached_property
    def work_records(self) -> DataFrame:
        start = F.expr(
            "timestamp_ntz '2024-01-01 05:00:00' + make_dt_interval("
            "cast(l_orderkey % 30 as int), 0, cast(l_partkey % 240 as int), 0)"
        )
        length = F.expr("make_dt_interval(0, 0, cast(round(l_quantity * 10) as int), 0)")
        records = self._read("lineitem").select(
            (F.col("l_partkey") % 150).alias("employee_id"),
            start.alias("start_ts"),
            (start + length).alias("stop_ts"),
            (F.col("l_quantity") / 6.0).alias("hours"),
            F.round(F.col("l_discount") * 1000).alias("engagement"),
            F.col("l_linenumber").alias("flags"),
        )
        return conform(records, "work_records")

    @cached_property
    def clock_events(self) -> DataFrame:
        event_type = F.coalesce(
            *[F.when(F.col("event_type") == kind, code) for kind, code in EVENT_TYPES.items()]
        )
        events = self._read("events").select(
            "event_id",
            F.col("ts").alias("event_ts"),
            event_type.alias("event_type"),
            F.col("user_id").alias("employee_id"),
        )
        return conform(events, "clock_events")

    @cached_property
    def employees(self) -> DataFrame:
        """All customers.

        Those with a negated id never clock in, so their positive ids are the
        unknown employees of the activity.
        """
        key = F.col("c_custkey")
        shared = F.when(key % 20 == 1, key - 1).otherwise(key)
        last_name = F.split_part("c_name", F.lit("#"), F.lit(2))
        employees = self._read("customer").select(
            F.when(key % 10 == 9, -key).otherwise(key).alias("employee_id"),
            F.concat(F.lit("login"), shared.cast("string")).alias("login"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.when(key % 50 != 48, last_name).alias("last_name"),
            (key % 3 + 1).alias("shift_id"),
            F.col("c_nationkey").alias("department_id"),
            (F.col("c_nationkey") % 5).alias("position_id"),
        )
        return conform(employees, "employees")

    @cached_property
    def employee_attributes(self) -> DataFrame:
        """All customers; a negated id leaves an employee without attributes."""
        key = F.col("c_custkey")
        attributes = self._read("customer").select(
            F.when(key % 7 == 3, -key).otherwise(key).alias("employee_id"),
            F.concat(F.lit("B"), (key % 4).cast("string")).alias("bibi"),
            F.col("c_mktsegment").alias("department"),
            F.concat(F.lit("F"), F.col("c_nationkey").cast("string")).alias("job_function"),
            F.when(key % 2 == 0, "HC").otherwise("AGENCY").alias("hc_or_agency"),
            F.concat(F.lit("P"), (key % 5).cast("string")).alias("position"),
        )
        return conform(attributes, "employee_attributes")

    @cached_property
    def departments(self) -> DataFrame:
        keys = self._read("nation").select(F.col("n_nationkey").alias("department_id"))
        return conform(keys, "departments")

    @cached_property
    def positions(self) -> DataFrame:
        keys = self._read("region").select(F.col("r_regionkey").alias("position_id"))
        return conform(keys, "positions")


class HardSampleTables(SampleTables):
    """The same data with what the reports must bear: repeated events, equal
    times, records without an end or an employee, repeated dimension keys."""

    @cached_property
    def work_records(self) -> DataFrame:
        records = super().work_records
        minute = F.minute("start_ts")
        return records.withColumns(
            {
                "stop_ts": F.when(minute % 3 != 0, F.col("stop_ts")),
                "employee_id": F.when(minute % 7 != 0, F.col("employee_id")),
            }
        )

    @cached_property
    def clock_events(self) -> DataFrame:
        number = F.col("event_id")
        day = F.col("event_ts").cast("date").cast("timestamp_ntz")
        events = super().clock_events.withColumns(
            {
                "employee_id": F.when(number % 13 != 0, F.col("employee_id") % 40),
                "event_ts": F.when(number % 5 == 0, day + F.expr("INTERVAL '12' HOUR")).otherwise(
                    F.col("event_ts")
                ),
            }
        )
        return events.unionByName(events.filter(number % 7 == 0)).unionByName(
            events.filter(number % 35 == 0)
        )

    @cached_property
    def departments(self) -> DataFrame:
        keys = super().departments
        return keys.unionByName(keys.filter(F.col("department_id") % 2 == 0))

    @cached_property
    def positions(self) -> DataFrame:
        keys = super().positions
        return keys.unionByName(keys.filter(F.col("position_id") % 2 == 0))

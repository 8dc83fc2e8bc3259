"""Readers: the six tables as typed DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftledger.functions.clock import as_day
from shiftledger.operators.filters import PARTITION_DAY
from shiftledger.sources.schemas import RELATION_COLUMNS, RELATIONS, SCHEMAS

FACT_TABLES = ("work_records", "clock_events")


@dataclass(frozen=True)
class Tables:
    work_records: DataFrame
    clock_events: DataFrame
    employees: DataFrame
    departments: DataFrame
    employee_attributes: DataFrame
    positions: DataFrame
    #: Whether events may be counted before they are read; False where a count costs a transfer.
    count_events: bool = True


def decimals_as_double(df: DataFrame) -> DataFrame:
    """Every decimal column as double; nulls stay null."""
    return df.select(
        *[
            F.col(field.name).cast("double").alias(field.name)
            if isinstance(field.dataType, T.DecimalType)
            else F.col(field.name)
            for field in df.schema.fields
        ]
    )


def _wall_clock(instant: Column, zone: str) -> Column:
    """An instant as the wall clock of ``zone`` shows it, whatever the session zone."""
    seconds = (F.unix_micros(instant).cast("decimal(18,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    utc = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def conform(
    df: DataFrame, table: str, day_partition: str | None = None, source_zone: str | None = None
) -> DataFrame:
    """Select and type the columns of ``table``.

    ``day_partition`` names a column that equals the calendar day of the row, or
    is null; a day range then prunes it.  No column is taken for one by its name.
    Instants (``TIMESTAMP``) are read as the wall clock of ``source_zone``, and
    refused without it, as the session zone would decide what they mean.
    """
    types = {field.name: field.dataType for field in df.schema.fields}

    def typed(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampNTZType) and isinstance(
            types.get(field.name), T.TimestampType
        ):
            if source_zone is None:
                raise ValueError(f"{table}.{field.name} is an instant: name its source_zone")
            column = _wall_clock(column, source_zone)
        return column.cast(field.dataType).alias(field.name)

    columns = [typed(field) for field in SCHEMAS[table].fields]
    if day_partition is not None and day_partition in types:
        columns.append(F.col(f"`{day_partition}`").cast("date").alias(PARTITION_DAY))
    return df.select(*columns)


def read_tables(
    spark: SparkSession,
    root: str,
    fmt: str = "parquet",
    day_partition: str | None = None,
    source_zone: str | None = None,
    **options,
) -> Tables:
    """Read ``root/<table>`` for each table in any Spark file format; see ``conform``."""
    reader = spark.read.format(fmt).options(**options)

    def table(name: str) -> DataFrame:
        dated = day_partition if name in FACT_TABLES else None
        return conform(reader.load(f"{root}/{name}"), name, dated, source_zone)

    return Tables(**{name: table(name) for name in SCHEMAS})


def read_relations(
    load: Callable[[str], DataFrame], source_zone: str | None = None, count_events: bool = True
) -> Tables:
    """Tables from the operational database's own relations.

    ``load`` maps a relation name to a DataFrame with the database's column
    names: a parquet export, a catalog table or a JDBC read.
    """

    def table(name: str) -> DataFrame:
        names = RELATION_COLUMNS[name]
        source = decimals_as_double(load(RELATIONS[name]))
        renamed = source.select(*[F.col(old).alias(new) for new, old in names.items()])
        return conform(renamed, name, source_zone=source_zone)

    return Tables(**{name: table(name) for name in SCHEMAS}, count_events=count_events)


def slice_predicates(
    column: str, from_day: date | str, to_day: date | str, slices: int = 64
) -> list[str]:
    """At most ``slices`` adjacent, disjoint time ranges over whole days, one per read task."""
    if slices < 1:
        raise ValueError("slices start at 1")
    first, last = as_day(from_day), as_day(to_day)
    end = ((last - first).days + 1) * 86_400
    step = -(-end // slices)
    predicates = []
    for second in range(0, end, step):
        low = f"timestamp '{first}' + interval '{second} seconds'"
        high = f"timestamp '{first}' + interval '{min(second + step, end)} seconds'"
        predicates.append(f"{column} >= {low} AND {column} < {high}")
    return predicates


def read_jdbc(
    spark: SparkSession,
    url: str,
    from_day: date | str,
    to_day: date | str,
    properties: dict[str, str] | None = None,
    slices: int = 64,
) -> Tables:
    """Tables straight from the database; fact tables in ``slices`` parallel time ranges.

    Events are not counted beforehand, as that would transfer them twice; a
    report that needs the split of hot employee-days should read a copy.
    """
    properties = {"preferTimestampNTZ": "true", **(properties or {})}
    time_columns = {
        RELATIONS[name]: RELATION_COLUMNS[name][column]
        for name, column in (("work_records", "start_ts"), ("clock_events", "event_ts"))
    }

    def load(relation: str) -> DataFrame:
        if relation not in time_columns:
            return spark.read.jdbc(url, relation, properties=properties)
        predicates = slice_predicates(time_columns[relation], from_day, to_day, slices)
        return spark.read.jdbc(url, relation, predicates=predicates, properties=properties)

    return read_relations(load, count_events=False)

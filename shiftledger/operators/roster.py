"""Left joins that attach employee master data.

``employee_id`` of the activity meets the employees; everything else hangs on
the employee found (``master_id``), so an unknown employee gets nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.sources.tables import Tables


def master_data(employees: DataFrame) -> DataFrame:
    return employees.select(
        F.col("employee_id").alias("master_id"),
        "login",
        "first_name",
        "last_name",
        "shift_id",
        "department_id",
        "position_id",
    )


def join_employees(activity: DataFrame, master: DataFrame) -> DataFrame:
    return activity.join(master, activity["employee_id"] == master["master_id"], "left")


def join_attributes(df: DataFrame, employee_attributes: DataFrame) -> DataFrame:
    attributes = employee_attributes.select(
        F.col("employee_id").alias("attributes_of"),
        "bibi",
        "department",
        "job_function",
        "hc_or_agency",
        "position",
    )
    return df.join(attributes, df["master_id"] == attributes["attributes_of"], "left").drop(
        "attributes_of"
    )


def join_departments(df: DataFrame, departments: DataFrame) -> DataFrame:
    """Adds no column; repeats a row if the department id is not unique."""
    keys = departments.select(F.col("department_id").alias("department_key"))
    return df.join(keys, df["department_id"] == keys["department_key"], "left").drop(
        "department_key"
    )


def join_positions(df: DataFrame, positions: DataFrame) -> DataFrame:
    """Adds no column; repeats a row if the position id is not unique."""
    keys = positions.select(F.col("position_id").alias("position_key"))
    return df.join(keys, df["position_id"] == keys["position_key"], "left").drop("position_key")


def attach_members(people: DataFrame, tables: Tables) -> DataFrame:
    """Person-days with everything known about the employee.

    Joins on the login as well, for an employee id that carries several.
    """
    master = master_data(tables.employees).withColumnsRenamed(
        {"master_id": "known_id", "login": "known_login"}
    )
    named = people.join(
        master,
        (people["master_id"] == master["known_id"])
        & people["login"].eqNullSafe(master["known_login"]),
        "left",
    )
    return join_attributes(named, tables.employee_attributes)


def _attach(df: DataFrame, tables: Tables, row_exact: bool) -> DataFrame:
    df = join_attributes(df, tables.employee_attributes)
    if row_exact:
        df = join_departments(df, tables.departments)
        df = join_positions(df, tables.positions)
    return df


def enrich(
    activity: DataFrame, tables: Tables, small_roster: bool, row_exact: bool = True
) -> DataFrame:
    """Activity with login, names, shift and attributes of its employee.

    A small roster is joined to the activity table by table, and Spark broadcasts
    each.  Otherwise the master data is put together first, so that the activity
    is shuffled for one join instead of two; adaptive execution splits a hot
    employee there.

    ``row_exact=False`` leaves out the joins that can only repeat rows.
    """
    master = master_data(tables.employees)
    if small_roster:
        return _attach(join_employees(activity, master), tables, row_exact)
    return join_employees(activity, _attach(master, tables, row_exact))

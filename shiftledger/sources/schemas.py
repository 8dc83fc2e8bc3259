"""The six input tables."""

from __future__ import annotations

from pyspark.sql import types as T

WORK_RECORDS = T.StructType(
    [
        T.StructField("employee_id", T.LongType()),
        T.StructField("start_ts", T.TimestampNTZType()),
        T.StructField("stop_ts", T.TimestampNTZType()),
        T.StructField("hours", T.DoubleType()),
        T.StructField("engagement", T.DoubleType()),
        T.StructField("flags", T.IntegerType()),
    ]
)
CLOCK_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("event_ts", T.TimestampNTZType()),
        T.StructField("event_type", T.IntegerType()),
        T.StructField("employee_id", T.LongType()),
    ]
)
EMPLOYEES = T.StructType(
    [
        T.StructField("employee_id", T.LongType()),
        T.StructField("login", T.StringType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("shift_id", T.IntegerType()),
        T.StructField("department_id", T.IntegerType()),
        T.StructField("position_id", T.IntegerType()),
    ]
)
DEPARTMENTS = T.StructType([T.StructField("department_id", T.IntegerType())])
EMPLOYEE_ATTRIBUTES = T.StructType(
    [
        T.StructField("employee_id", T.LongType()),
        T.StructField("bibi", T.StringType()),
        T.StructField("department", T.StringType()),
        T.StructField("job_function", T.StringType()),
        T.StructField("hc_or_agency", T.StringType()),
        T.StructField("position", T.StringType()),
    ]
)
POSITIONS = T.StructType([T.StructField("position_id", T.IntegerType())])

SCHEMAS = {
    "work_records": WORK_RECORDS,
    "clock_events": CLOCK_EVENTS,
    "employees": EMPLOYEES,
    "departments": DEPARTMENTS,
    "employee_attributes": EMPLOYEE_ATTRIBUTES,
    "positions": POSITIONS,
}

# Relation and column names of the operational database.
RELATIONS = {
    "work_records": "tg_praceall",
    "clock_events": "tb_rcp_wydarzenia",
    "employees": "tb_pracownicy",
    "departments": "ts_dzialy",
    "employee_attributes": "mvv.tb_pracownicy_mv",
    "positions": "ts_stanowisko",
}
RELATION_COLUMNS = {
    "work_records": {
        "employee_id": "p_idpracownika",
        "start_ts": "pra_datastart",
        "stop_ts": "pra_datastop",
        "hours": "pra_rbh",
        "engagement": "pra_zaangazpracownika",
        "flags": "pra_flaga",
    },
    "clock_events": {
        "event_id": "rcp_idwydarzenia",
        "event_ts": "rcp_czaswydarzenia",
        "event_type": "rcp_typwydarzenia",
        "employee_id": "p_idpracownika",
    },
    "employees": {
        "employee_id": "p_idpracownika",
        "login": "p_login",
        "first_name": "p_imie",
        "last_name": "p_nazwisko",
        "shift_id": "zm_idzmiany",
        "department_id": "dz_iddzialu",
        "position_id": "st_idstanowiska",
    },
    "departments": {"department_id": "dz_iddzialu"},
    "employee_attributes": {
        "employee_id": "p_idpracownika",
        "bibi": "p_value1527",
        "department": "p_value1447",
        "job_function": "p_value1449",
        "hc_or_agency": "p_value1448",
        "position": "p_value1479",
    },
    "positions": {"position_id": "st_idstanowiska"},
}

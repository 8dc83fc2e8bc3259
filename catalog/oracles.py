"""The registered queries in SQL, over the sample tables as views."""

from __future__ import annotations

from catalog.queries import AS_OF, FROM_DAY, TO_DAY

_TABLES = """
work_records AS (
    SELECT l_partkey % 150 AS employee_id,
           TIMESTAMP '2024-01-01 05:00:00' + to_days(CAST(l_orderkey % 30 AS INTEGER))
               + to_minutes(l_partkey % 240) AS start_ts,
           TIMESTAMP '2024-01-01 05:00:00' + to_days(CAST(l_orderkey % 30 AS INTEGER))
               + to_minutes(l_partkey % 240)
               + to_minutes(CAST(round(l_quantity * 10) AS BIGINT)) AS stop_ts,
           l_quantity / 6.0 AS hours,
           round(l_discount * 1000) AS engagement,
           CAST(l_linenumber AS INTEGER) AS flags
    FROM lineitem
),
clock_events AS (
    SELECT event_id,
           ts AS event_ts,
           CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3
                           WHEN 'purchase' THEN 4 WHEN 'error' THEN 5 END AS event_type,
           user_id AS employee_id
    FROM events
),
employees AS (
    SELECT CASE WHEN c_custkey % 10 = 9 THEN -c_custkey ELSE c_custkey END AS employee_id,
           'login' || CASE WHEN c_custkey % 20 = 1 THEN c_custkey - 1 ELSE c_custkey END AS login,
           split_part(c_name, '#', 1) AS first_name,
           CASE WHEN c_custkey % 50 <> 48 THEN split_part(c_name, '#', 2) END AS last_name,
           CAST(c_custkey % 3 + 1 AS INTEGER) AS shift_id,
           CAST(c_nationkey AS INTEGER) AS department_id,
           CAST(c_nationkey % 5 AS INTEGER) AS position_id
    FROM customer
),
departments AS (SELECT CAST(n_nationkey AS INTEGER) AS department_id FROM nation),
employee_attributes AS (
    SELECT CASE WHEN c_custkey % 7 = 3 THEN -c_custkey ELSE c_custkey END AS employee_id,
           'B' || c_custkey % 4 AS bibi,
           c_mktsegment AS department,
           'F' || c_nationkey AS job_function,
           CASE WHEN c_custkey % 2 = 0 THEN 'HC' ELSE 'AGENCY' END AS hc_or_agency,
           'P' || c_custkey % 5 AS position
    FROM customer
),
positions AS (SELECT CAST(r_regionkey AS INTEGER) AS position_id FROM region)"""

#: The sample with repeats and gaps: its tables are made from those above.
_HARD_TABLES = (
    _TABLES.replace("work_records AS (", "plain_work AS (")
    .replace("clock_events AS (", "plain_events AS (")
    .replace("\ndepartments AS (", "\nplain_departments AS (")
    .replace("positions AS (", "plain_positions AS (")
    + """,
work_records AS (
    SELECT * REPLACE (
        CASE WHEN extract('minute' FROM start_ts) % 3 <> 0 THEN stop_ts END AS stop_ts,
        CASE WHEN extract('minute' FROM start_ts) % 7 <> 0 THEN employee_id END AS employee_id)
    FROM plain_work
),
changed_events AS (
    SELECT * REPLACE (
        CASE WHEN event_id % 13 <> 0 THEN employee_id % 40 END AS employee_id,
        CASE WHEN event_id % 5 = 0 THEN CAST(event_ts AS DATE) + INTERVAL '12 hours'
             ELSE event_ts END AS event_ts)
    FROM plain_events
),
clock_events AS (
    SELECT * FROM changed_events
    UNION ALL SELECT * FROM changed_events WHERE event_id % 7 = 0
    UNION ALL SELECT * FROM changed_events WHERE event_id % 35 = 0
),
departments AS (
    SELECT * FROM plain_departments
    UNION ALL SELECT * FROM plain_departments WHERE department_id % 2 = 0
),
positions AS (
    SELECT * FROM plain_positions
    UNION ALL SELECT * FROM plain_positions WHERE position_id % 2 = 0
)"""
)

_ACTIVITY = f"""{_TABLES},
work_days AS (
    SELECT employee_id,
           CAST(start_ts AS DATE) AS day,
           sum(hours) AS hours,
           sum(hours * (engagement / 100)) AS effective_hours,
           min(start_ts) AS start_ts,
           max(stop_ts) AS stop_ts
    FROM work_records
    WHERE (flags & 2) = 2
      AND CAST(start_ts AS DATE) BETWEEN DATE '{FROM_DAY}' AND DATE '{TO_DAY}'
    GROUP BY employee_id, CAST(start_ts AS DATE)
),
event_window AS (
    SELECT *, CAST(event_ts AS DATE) AS day
    FROM clock_events
    WHERE CAST(event_ts AS DATE) BETWEEN DATE '{FROM_DAY}' AND DATE '{TO_DAY}'
      AND CAST(event_ts AS TIME) <= TIME '22:59:59'
),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY employee_id, day
                                 ORDER BY event_ts, event_id, event_type) AS place
    FROM event_window
),
followed AS (
    -- the event one place further on, of the same employee and day
    SELECT n.*, later.event_ts AS next_ts
    FROM numbered n
    LEFT JOIN numbered later
      ON later.employee_id IS NOT DISTINCT FROM n.employee_id
     AND later.day = n.day AND later.place = n.place + 1
),
activity AS (
    SELECT CAST(employee_id AS VARCHAR) || CAST(day AS VARCHAR) AS search_key,
           employee_id, hours, effective_hours, start_ts, stop_ts, day,
           CAST(NULL AS INTEGER) AS action, 0 AS source, CAST(NULL AS BIGINT) AS event_id
    FROM work_days
    UNION
    SELECT CAST(employee_id AS VARCHAR) || CAST(day AS VARCHAR) || CAST(event_id AS VARCHAR),
           employee_id,
           CASE WHEN event_type IN (1, 3)
                THEN date_diff('microsecond', event_ts,
                               coalesce(next_ts, TIMESTAMP '{AS_OF}')) / 3.6e9
                ELSE 0.0 END,
           0.0, event_ts, coalesce(next_ts, TIMESTAMP '{AS_OF}'), day, event_type, 1, event_id
    FROM followed
    WHERE event_type IN (1, 2, 3, 4)
)"""


def _span(start: str, stop: str) -> str:
    return (
        f"(CAST(extract('hour' FROM {stop} - {start}) AS VARCHAR) || ':' || "
        f"CAST(extract('minute' FROM {stop} - {start}) AS VARCHAR))"
    )


_DETAIL = f"""{_ACTIVITY},
enriched AS (
    SELECT a.*, e.login, e.first_name || ' ' || e.last_name AS full_name, e.shift_id,
           m.bibi, m.department, m.job_function, m.hc_or_agency, m.position
    FROM activity a
    LEFT JOIN employees e ON e.employee_id = a.employee_id
    LEFT JOIN departments d ON d.department_id = e.department_id
    LEFT JOIN employee_attributes m ON e.employee_id = m.employee_id
    LEFT JOIN positions p ON p.position_id = e.position_id
),
detail AS (
    SELECT *, strftime(start_ts, '%H:%M') AS start_hm, strftime(stop_ts, '%H:%M') AS stop_hm,
           {_span("start_ts", "stop_ts")} AS duration_hm
    FROM enriched
)"""

_SUMMARY = f"""{_DETAIL},
employee_days AS (
    SELECT DISTINCT login, day, full_name, bibi, department, job_function, hc_or_agency,
                    position, shift_id
    FROM detail
),
login_times AS (
    SELECT login, day, min(start_hm) AS start_hm, max(stop_hm) AS stop_hm
    FROM detail GROUP BY login, day
),
login_breaks AS (
    SELECT login, day, duration_hm AS break_hm
    FROM detail WHERE action = 3
    QUALIFY row_number() OVER (PARTITION BY login, day ORDER BY start_ts, event_id, stop_ts) = 1
),
timed AS (
    SELECT s.*, t.start_hm, t.stop_hm, b.break_hm,
           CAST(substr(t.start_hm, 1, 2) AS INTEGER) * 60
               + CAST(substr(t.start_hm, 4, 2) AS INTEGER) AS start_minutes,
           CAST(substr(t.stop_hm, 1, 2) AS INTEGER) * 60
               + CAST(substr(t.stop_hm, 4, 2) AS INTEGER) AS stop_minutes
    FROM employee_days s
    LEFT JOIN login_times t ON t.login IS NOT DISTINCT FROM s.login AND t.day = s.day
    LEFT JOIN login_breaks b ON b.login IS NOT DISTINCT FROM s.login AND b.day = s.day
),
worked AS (
    SELECT *, CASE WHEN stop_minutes < start_minutes THEN stop_minutes - start_minutes + 1440
                   ELSE stop_minutes - start_minutes END AS minutes
    FROM timed
),
checked AS (
    SELECT *,
           lpad(CAST(minutes // 60 AS VARCHAR), 2, '0') || ':'
               || lpad(CAST(minutes % 60 AS VARCHAR), 2, '0') AS worked_hm,
           CAST(NULL AS VARCHAR) AS comment,
           CASE WHEN start_hm <= '06:00' THEN 'OK' ELSE start_hm END AS start_check,
           CASE WHEN minutes < 480 THEN stop_hm WHEN minutes >= 480 THEN 'OK' END AS end_check,
           CASE WHEN minutes < 480 THEN 'Poniżej 8h' WHEN minutes >= 480 THEN 'OK' END
               AS hours_check,
           CASE WHEN break_hm <> '' THEN 'OK' ELSE 'brak przerwy' END AS break_check
    FROM worked
),
summary AS (
    SELECT login, day, full_name, bibi, department, job_function, hc_or_agency, position,
           shift_id, start_hm, stop_hm, worked_hm, break_hm, comment, start_check, end_check,
           hours_check, break_check,
           CASE WHEN start_check = 'OK' AND end_check = 'OK' AND hours_check = 'OK'
                     AND break_check = 'OK' THEN '✔️' ELSE '❌' END AS verdict
    FROM checked
)"""

_SUMMARY_COLUMNS = [
    ("login", "Login"),
    ("day", "Data"),
    ("full_name", "Imię i Nazwisko"),
    ("bibi", "BIBI"),
    ("department", "Departament"),
    ("job_function", "Funkcja"),
    ("hc_or_agency", "HC/AGENCY"),
    ("position", "Pozycja"),
    ("shift_id", "Zmiana"),
    ("start_hm", "StartPracy"),
    ("stop_hm", "Koniec Pracy"),
    ("worked_hm", "Czas Pracy"),
    ("break_hm", "Przerwa śniadaniowa"),
    ("comment", "Komentarz"),
    ("start_check", "Rozpoczęcie"),
    ("end_check", "Zakończenie"),
    ("hours_check", "Sprawdzenie czasu pracy"),
    ("break_check", "Sprawdzanie śniadaniowa"),
    ("verdict", "Podsumowanie "),
]
_DETAIL_COLUMNS = [
    ("day", "Data"),
    ("full_name", "Imię i Nazwisko"),
    ("login", "Login"),
    ("bibi", "BIBI"),
    ("department", "Departament"),
    ("job_function", "Funkcja"),
    ("hc_or_agency", "HC/AGENCY"),
    ("position", "Pozycja"),
    ("shift_id", "Zmiana"),
    ("start_hm", "StartPracy"),
    ("stop_hm", "Koniec Pracy"),
    ("duration_hm", "Czas Pracy"),
    ("action", "Przerwa"),
]


def _on(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"


def _named(columns: list[tuple[str, str]]) -> str:
    return ", ".join(f'{name} AS "{label}"' for name, label in columns)


def _plain(columns: list[tuple[str, str]]) -> str:
    return ", ".join(name for name, _ in columns)


def _cell(name: str) -> str:
    return f"coalesce(CAST({name} AS VARCHAR), '')"


def _facets() -> str:
    return " UNION ".join(
        f"SELECT '{name}' AS column_name, {_cell(name)} AS value FROM summary"
        for name, _ in _SUMMARY_COLUMNS
    )


def _widths() -> str:
    texts = [(n, label) for n, label in _SUMMARY_COLUMNS if n not in ("day", "shift_id")]
    rows = [
        f"SELECT '{label}' AS column_name, CAST(greatest(coalesce(max(length({name})), 0), "
        f"length('{label}')) + 2 AS INTEGER) AS width FROM summary"
        for name, label in texts
    ]
    rows += [
        f"SELECT '{label}', CAST(length('{label}') + 2 AS INTEGER)" for label in ("Data", "Zmiana")
    ]
    return " UNION ALL ".join(rows)


def _summary_columns(*columns: str) -> str:
    return _on(_SUMMARY, f"SELECT login, day, full_name, {', '.join(columns)} FROM checked")


_ROW_TEXT = " || '  ' || ".join(_cell(name) for name, _ in _SUMMARY_COLUMNS)
_ALL_FIRST = ", ".join(f"{name} NULLS FIRST" for name, _ in _SUMMARY_COLUMNS)
# Event hours are compared exactly; sums are rounded, as engines add in another order.
_ROUNDED_ACTIVITY = (
    "search_key, employee_id, CASE WHEN source = 0 THEN round(hours, 6) ELSE hours END AS hours, "
    "round(effective_hours, 6) AS effective_hours, start_ts, stop_ts, day, action, source, event_id"
)
_NEXT_EVENT = _on(
    _ACTIVITY, "SELECT employee_id, day, event_ts, event_id, event_type, next_ts FROM followed"
)
_EVENT_INTERVALS = _on(_ACTIVITY, f"SELECT {_ROUNDED_ACTIVITY} FROM activity WHERE source = 1")
_DETAIL_REPORT = _on(_DETAIL, f"SELECT {_plain(_DETAIL_COLUMNS)} FROM detail")
_SUMMARY_REPORT = _on(_SUMMARY, "SELECT * FROM summary")

ORACLES: dict[str, str] = {
    "scan_work_records": _on(
        _TABLES,
        "SELECT employee_id, start_ts, stop_ts, round(hours, 6) AS hours, engagement, flags "
        "FROM work_records",
    ),
    "scan_clock_events": _on(_TABLES, "SELECT * FROM clock_events"),
    "scan_employees": _on(_TABLES, "SELECT * FROM employees"),
    "scan_departments": _on(_TABLES, "SELECT * FROM departments"),
    "scan_employee_attributes": _on(_TABLES, "SELECT * FROM employee_attributes"),
    "scan_positions": _on(_TABLES, "SELECT * FROM positions"),
    "decimal_to_double": (
        "SELECT l_orderkey, l_linenumber, "
        "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS price, "
        "CAST(nullif(CAST(l_tax AS DECIMAL(4,2)), 0) AS DOUBLE) AS tax FROM lineitem"
    ),
    "filter_day_range": _on(
        _TABLES,
        "SELECT * FROM clock_events "
        "WHERE CAST(event_ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'",
    ),
    "filter_flag_bit": _on(
        _TABLES, "SELECT employee_id, start_ts, flags FROM work_records WHERE flags & 2 = 2"
    ),
    "filter_event_window": _on(
        _ACTIVITY, "SELECT event_id, event_ts, event_type, employee_id FROM event_window"
    ),
    "filter_event_types": _on(
        _ACTIVITY,
        "SELECT employee_id, day, event_ts, event_id, event_type, next_ts FROM followed "
        "WHERE event_type IN (1, 2, 3, 4)",
    ),
    "work_day_hours": _on(
        _ACTIVITY, "SELECT employee_id, day, round(hours, 6) AS hours FROM work_days"
    ),
    "work_day_effective_hours": _on(
        _ACTIVITY,
        "SELECT employee_id, day, round(effective_hours, 6) AS effective_hours FROM work_days",
    ),
    "work_day_span": _on(_ACTIVITY, "SELECT employee_id, day, start_ts, stop_ts FROM work_days"),
    "work_day_agg": _on(
        _ACTIVITY,
        "SELECT employee_id, day, round(hours, 6) AS hours, "
        "round(effective_hours, 6) AS effective_hours, start_ts, stop_ts FROM work_days",
    ),
    "next_event": _NEXT_EVENT,
    "next_event_split": _NEXT_EVENT,
    "event_hours": _on(_ACTIVITY, "SELECT event_id, hours FROM activity WHERE source = 1"),
    "event_intervals": _EVENT_INTERVALS,
    "event_intervals_split": _EVENT_INTERVALS,
    "activity_union": _on(_ACTIVITY, f"SELECT {_ROUNDED_ACTIVITY} FROM activity"),
    "fn_to_date": _on(_TABLES, "SELECT event_id, CAST(event_ts AS DATE) AS day FROM clock_events"),
    "fn_search_key": _on(_ACTIVITY, "SELECT search_key, employee_id, source FROM activity"),
    "fn_full_name": _on(
        _TABLES, "SELECT employee_id, first_name || ' ' || last_name AS full_name FROM employees"
    ),
    "fn_open_interval_end": _on(
        _ACTIVITY,
        f"SELECT event_id, coalesce(next_ts, TIMESTAMP '{AS_OF}') AS stop_ts FROM followed",
    ),
    "fn_duration_hm": _on(_DETAIL, "SELECT search_key, duration_hm FROM detail"),
    "fn_time_of_day": _on(_DETAIL, "SELECT search_key, start_hm, stop_hm FROM detail"),
    "fn_hm_to_minutes": _on(
        _DETAIL,
        "SELECT search_key, start_hm, CAST(split_part(start_hm, ':', 1) AS INTEGER) * 60 "
        "+ CAST(split_part(start_hm, ':', 2) AS INTEGER) AS start_minutes FROM detail",
    ),
    "join_employee": _on(
        _ACTIVITY,
        "SELECT a.search_key, a.employee_id, e.login, e.first_name, e.last_name, e.shift_id, "
        "e.department_id, e.position_id FROM activity a "
        "LEFT JOIN employees e ON e.employee_id = a.employee_id",
    ),
    "join_attributes": _on(
        _ACTIVITY,
        "SELECT a.search_key, e.login, m.bibi, m.department, m.job_function, m.hc_or_agency, "
        "m.position FROM activity a LEFT JOIN employees e ON e.employee_id = a.employee_id "
        "LEFT JOIN employee_attributes m ON m.employee_id = e.employee_id",
    ),
    "join_department": _on(
        _ACTIVITY,
        "SELECT a.search_key, e.login, e.department_id FROM activity a "
        "LEFT JOIN employees e ON e.employee_id = a.employee_id "
        "LEFT JOIN departments d ON d.department_id = e.department_id",
    ),
    "join_position": _on(
        _ACTIVITY,
        "SELECT a.search_key, e.login, e.position_id FROM activity a "
        "LEFT JOIN employees e ON e.employee_id = a.employee_id "
        "LEFT JOIN positions p ON p.position_id = e.position_id",
    ),
    "detail_report": _DETAIL_REPORT,
    "detail_report_unique_dimensions": _DETAIL_REPORT,
    "detail_labeled": _on(_DETAIL, f"SELECT {_named(_DETAIL_COLUMNS)} FROM detail"),
    "employee_days": _on(_SUMMARY, "SELECT * FROM employee_days"),
    "login_first_start": _on(_SUMMARY, "SELECT day, login, start_hm FROM login_times"),
    "login_last_stop": _on(_SUMMARY, "SELECT day, login, stop_hm FROM login_times"),
    "first_break": _on(_SUMMARY, "SELECT day, login, break_hm FROM login_breaks"),
    "summary_times": _summary_columns("start_hm", "stop_hm"),
    "summary_break": _summary_columns("break_hm"),
    "worked_time": _summary_columns("worked_hm"),
    "check_start": _summary_columns("start_check"),
    "check_end": _summary_columns("end_check"),
    "check_hours": _summary_columns("hours_check"),
    "check_break": _summary_columns("break_check"),
    "verdict": _on(_SUMMARY, "SELECT login, day, full_name, verdict FROM summary"),
    "summary_report": _SUMMARY_REPORT,
    "summary_report_split": _SUMMARY_REPORT,
    "summary_report_large_roster": _SUMMARY_REPORT,
    "summary_labeled": _on(_SUMMARY, f"SELECT {_named(_SUMMARY_COLUMNS)} FROM summary"),
    "column_widths": _on(_SUMMARY, _widths()),
    "facet_values": _on(_SUMMARY, _facets()),
    "facet_filter": _on(
        _SUMMARY, "SELECT * FROM summary WHERE lower(coalesce(department, '')) = 'machinery'"
    ),
    "facet_filter_multi": _on(
        _SUMMARY,
        "SELECT * FROM summary "
        "WHERE department = 'MACHINERY' AND verdict = '✔️' AND shift_id = 2",
    ),
    "table_search": _on(
        _SUMMARY,
        f"SELECT * FROM summary WHERE contains(lower({_ROW_TEXT}), 'agency') "
        f"AND contains(lower({_ROW_TEXT}), 'poniżej 8h') AND contains(lower({_ROW_TEXT}), 'b1')",
    ),
    "table_sort": _on(
        _SUMMARY,
        f"SELECT * FROM summary ORDER BY lower(coalesce(full_name, '')) DESC, {_ALL_FIRST}",
    ),
    "table_page": _on(
        _SUMMARY,
        f"SELECT * FROM summary ORDER BY lower(coalesce(login, '')), {_ALL_FIRST} "
        "LIMIT 25 OFFSET 50",
    ),
    "table_page_deep": _on(
        _SUMMARY,
        f"SELECT * FROM summary ORDER BY lower(coalesce(login, '')) DESC, {_ALL_FIRST} "
        "LIMIT 300 OFFSET 900",
    ),
    "facet_filter_stored": _on(
        _SUMMARY,
        "SELECT * FROM summary WHERE lower(coalesce(department, '')) = 'machinery' "
        "AND day BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'",
    ),
}
_MULTI = "department = 'MACHINERY' AND verdict = '✔️' AND shift_id = 2"
ORACLES |= {
    "facet_values_indexed": _on(
        _SUMMARY,
        f"SELECT column_name, value, count(*) AS found FROM ({_facets().replace(' UNION ', ' UNION ALL ')}) "
        "GROUP BY column_name, value",
    ),
    "facet_count_indexed": _on(
        _SUMMARY,
        f"SELECT count(*) AS found FROM summary WHERE {_MULTI} "
        "AND day BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'",
    ),
    "facet_filter_indexed": ORACLES["facet_filter_multi"],
    "table_search_indexed": ORACLES["table_search"],
    "table_page_far": _on(
        _SUMMARY,
        f"SELECT * FROM summary ORDER BY lower(coalesce(full_name, '')) DESC, {_ALL_FIRST} "
        "LIMIT 100 OFFSET 1400",
    ),
}


def _hard(query: str) -> str:
    """The same query on the sample with repeats and gaps."""
    return query.replace(_TABLES.strip(), _HARD_TABLES.strip())


_HARD_NEXT = _hard(_NEXT_EVENT.replace("SELECT employee_id, day, event_ts", "SELECT DISTINCT employee_id, day, event_ts"))
ORACLES |= {
    "next_event_repeats": _HARD_NEXT,
    "next_event_repeats_split": _HARD_NEXT,
    "work_day_open_records": _hard(ORACLES["work_day_span"]),
    "activity_union_repeats": _hard(ORACLES["activity_union"]),
    "detail_report_repeated_keys": _hard(_DETAIL_REPORT),
    "detail_report_from_facts": _hard(_DETAIL_REPORT),
    "summary_report_open_records": _hard(_SUMMARY_REPORT),
    "summary_report_from_facts": _hard(_SUMMARY_REPORT),
}

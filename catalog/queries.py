"""Every operator as a query over the whole sample tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftledger.functions.clock import (
    calendar_day,
    duration_text,
    minutes_text,
    text_to_minutes,
    time_of_day,
)
from shiftledger.functions.text import full_name
from shiftledger.operators import browse, filters, roster
from shiftledger.operators.activity import WORK_SOURCE, activity, event_intervals, open_end
from shiftledger.operators.labels import DETAIL_LABELS, SUMMARY_LABELS, labeled
from shiftledger.operators.rollup import login_days
from shiftledger.operators.successors import next_event
from shiftledger.operators.widths import column_widths
from shiftledger.operators.work_days import work_days
from shiftledger.plans.reports import (
    detail_report,
    employee_day_rows,
    people,
    summary_report,
)
from shiftledger.rules import DEFAULT_RULES, Rules
from shiftledger.session import scratch_folder
from shiftledger.sources.report_index import StoredReport
from shiftledger.sources.sample import HardSampleTables, SampleTables
from shiftledger.sources.sinks import read_report, write_days
from shiftledger.sources.tables import Tables, decimals_as_double

FROM_DAY = "2024-01-01"
TO_DAY = "2024-01-30"
AS_OF = "2024-02-01 12:34:56"
PERIOD = (FROM_DAY, TO_DAY)
REPORT = (FROM_DAY, TO_DAY, AS_OF)
FACETS = {"department": "MACHINERY", "verdict": "✔️", "shift_id": "2"}
SEARCH = 'agency "poniżej 8h" b1'
#: Sends every event through the split of overfull groups.
ALL_HOT = {"hot_rows": 0}

Query = Callable[[SparkSession, str], DataFrame]


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


def _event_window(t: Tables) -> DataFrame:
    return filters.in_event_window(t.clock_events, *PERIOD, DEFAULT_RULES.event_cutoff)


def _intervals(t: Tables, **split) -> DataFrame:
    return event_intervals(t.clock_events, *REPORT, **split)


def _activity(t: Tables) -> DataFrame:
    return activity(t, *REPORT)


def _activity_union(t: Tables) -> DataFrame:
    """Sums depend on the order of addition and are rounded; event hours are exact."""
    summed = F.when(F.col("source") == WORK_SOURCE, F.round("hours", 6))
    return _rounded(_activity(t), "effective_hours").withColumn(
        "hours", summed.otherwise(F.col("hours"))
    )


def _with_employees(t: Tables) -> DataFrame:
    return roster.join_employees(_activity(t), roster.master_data(t.employees))


def _summary(t: Tables, *columns: str) -> DataFrame:
    return summary_report(t, *REPORT).select("login", "day", "full_name", *columns)


def _decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return decimals_as_double(
        lineitem.select(
            "l_orderkey",
            "l_linenumber",
            F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
            F.nullif(F.col("l_tax").cast("decimal(4,2)"), F.lit(0)).alias("tax"),
        )
    )


def _scan(table: str, t: Tables) -> DataFrame:
    df = getattr(t, table)
    return _rounded(df, "hours") if table == "work_records" else df


def _filter_flag_bit(t: Tables) -> DataFrame:
    flags = F.col("flags")
    kept = t.work_records.filter(filters.has_flag(flags, DEFAULT_RULES.work_flag))
    return kept.select("employee_id", "start_ts", "flags")


def _filter_event_types(t: Tables) -> DataFrame:
    listed = filters.of_types(F.col("event_type"), DEFAULT_RULES.listed_types)
    return next_event(_event_window(t)).filter(listed)


def _fn_hm_to_minutes(t: Tables) -> DataFrame:
    texts = _activity(t).select("search_key", time_of_day(F.col("start_ts")).alias("start_hm"))
    return texts.withColumn("start_minutes", text_to_minutes(F.col("start_hm")))


def _fn_open_interval_end(t: Tables) -> DataFrame:
    return next_event(_event_window(t)).select(
        "event_id", open_end(F.col("next_ts"), AS_OF).alias("stop_ts")
    )


def _detail_rows(t: Tables) -> DataFrame:
    return detail_report(t, *REPORT)


def _login_facts(t: Tables) -> DataFrame:
    first = F.col("first_break")
    return login_days(people(t, *REPORT)).select(
        "day",
        "login",
        minutes_text(F.col("start_minute")).alias("start_hm"),
        minutes_text(F.col("stop_minute")).alias("stop_hm"),
        duration_text(first["start_ts"], first["stop_ts"]).alias("break_hm"),
    )


def _first_break(t: Tables) -> DataFrame:
    return _login_facts(t).filter(F.col("break_hm").isNotNull()).select("day", "login", "break_hm")


def _summary_times(t: Tables) -> DataFrame:
    return _summary(t, "start_hm", "stop_hm")


def _browse(operator: Callable[..., DataFrame], t: Tables, *args, **kwargs) -> DataFrame:
    return operator(summary_report(t, *REPORT), *args, **kwargs)


_ON_TABLES: dict[str, Callable[[Tables], DataFrame]] = {
    # sources
    "scan_work_records": partial(_scan, "work_records"),
    "scan_clock_events": partial(_scan, "clock_events"),
    "scan_employees": partial(_scan, "employees"),
    "scan_departments": partial(_scan, "departments"),
    "scan_employee_attributes": partial(_scan, "employee_attributes"),
    "scan_positions": partial(_scan, "positions"),
    # filters
    "filter_day_range": lambda t: filters.in_day_range(
        t.clock_events, "event_ts", "2024-01-05", "2024-01-20"
    ),
    "filter_flag_bit": _filter_flag_bit,
    "filter_event_window": _event_window,
    "filter_event_types": _filter_event_types,
    # work days
    "work_day_hours": lambda t: _rounded(work_days(t.work_records, *PERIOD), "hours").select(
        "employee_id", "day", "hours"
    ),
    "work_day_effective_hours": lambda t: _rounded(
        work_days(t.work_records, *PERIOD), "effective_hours"
    ).select("employee_id", "day", "effective_hours"),
    "work_day_span": lambda t: work_days(t.work_records, *PERIOD).select(
        "employee_id", "day", "start_ts", "stop_ts"
    ),
    "work_day_agg": lambda t: _rounded(
        work_days(t.work_records, *PERIOD), "hours", "effective_hours"
    ),
    # events
    "next_event": lambda t: next_event(_event_window(t)),
    "next_event_split": lambda t: next_event(_event_window(t), **ALL_HOT),
    "event_hours": lambda t: _intervals(t).select("event_id", "hours"),
    "event_intervals": _intervals,
    "event_intervals_split": lambda t: _intervals(t, **ALL_HOT),
    # union
    "activity_union": _activity_union,
    # column functions
    "fn_to_date": lambda t: t.clock_events.select(
        "event_id", calendar_day(F.col("event_ts")).alias("day")
    ),
    "fn_search_key": lambda t: _activity(t).select("search_key", "employee_id", "source"),
    "fn_full_name": lambda t: t.employees.select(
        "employee_id", full_name(F.col("first_name"), F.col("last_name")).alias("full_name")
    ),
    "fn_open_interval_end": _fn_open_interval_end,
    "fn_duration_hm": lambda t: _activity(t).select(
        "search_key", duration_text(F.col("start_ts"), F.col("stop_ts")).alias("duration_hm")
    ),
    "fn_time_of_day": lambda t: _activity(t).select(
        "search_key",
        time_of_day(F.col("start_ts")).alias("start_hm"),
        time_of_day(F.col("stop_ts")).alias("stop_hm"),
    ),
    "fn_hm_to_minutes": _fn_hm_to_minutes,
    # joins
    "join_employee": lambda t: _with_employees(t).select(
        "search_key",
        "employee_id",
        "login",
        "first_name",
        "last_name",
        "shift_id",
        "department_id",
        "position_id",
    ),
    "join_attributes": lambda t: roster.join_attributes(
        _with_employees(t), t.employee_attributes
    ).select(
        "search_key", "login", "bibi", "department", "job_function", "hc_or_agency", "position"
    ),
    "join_department": lambda t: roster.join_departments(
        _with_employees(t), t.departments
    ).select("search_key", "login", "department_id"),
    "join_position": lambda t: roster.join_positions(_with_employees(t), t.positions).select(
        "search_key", "login", "position_id"
    ),
    # detail
    "detail_report": _detail_rows,
    "detail_report_unique_dimensions": lambda t: detail_report(
        t, *REPORT, rules=Rules(assume_unique_dimensions=True)
    ),
    "detail_labeled": lambda t: labeled(_detail_rows(t), DETAIL_LABELS),
    # summary
    "employee_days": lambda t: employee_day_rows(t, *PERIOD),
    "login_first_start": lambda t: _login_facts(t).select("day", "login", "start_hm"),
    "login_last_stop": lambda t: _login_facts(t).select("day", "login", "stop_hm"),
    "first_break": _first_break,
    "summary_times": _summary_times,
    "summary_break": lambda t: _summary(t, "break_hm"),
    "worked_time": lambda t: _summary(t, "worked_hm"),
    "check_start": lambda t: _summary(t, "start_check"),
    "check_end": lambda t: _summary(t, "end_check"),
    "check_hours": lambda t: _summary(t, "hours_check"),
    "check_break": lambda t: _summary(t, "break_check"),
    "verdict": lambda t: _summary(t, "verdict"),
    "summary_report": lambda t: summary_report(t, *REPORT),
    "summary_report_split": lambda t: summary_report(t, *REPORT, **ALL_HOT),
    "summary_report_large_roster": lambda t: summary_report(t, *REPORT, small_roster=False),
    "summary_labeled": lambda t: labeled(summary_report(t, *REPORT), SUMMARY_LABELS),
    "column_widths": lambda t: column_widths(labeled(summary_report(t, *REPORT), SUMMARY_LABELS)),
    # browsing
    "facet_values": lambda t: _browse(browse.facet_values, t),
    "facet_filter": lambda t: _browse(browse.facet_filter, t, {"department": "machinery"}),
    "facet_filter_multi": lambda t: _browse(browse.facet_filter, t, FACETS),
    "table_search": lambda t: _browse(browse.table_search, t, SEARCH),
    "table_sort": lambda t: _browse(browse.table_sort, t, "full_name", ascending=False),
    "table_page": lambda t: _browse(browse.table_page, t, page=3, size=25),
    "table_page_far": lambda t: _browse(
        browse.table_page, t, page=15, size=100, column="full_name", ascending=False
    ),
}

#: On the sample with repeats and gaps.
_ON_HARD_TABLES: dict[str, Callable[[Tables], DataFrame]] = {
    "next_event_repeats": lambda t: next_event(_event_window(t)),
    "next_event_repeats_split": lambda t: next_event(_event_window(t), **ALL_HOT),
    "work_day_open_records": lambda t: work_days(t.work_records, *PERIOD).select(
        "employee_id", "day", "start_ts", "stop_ts"
    ),
    "activity_union_repeats": _activity_union,
    "detail_report_repeated_keys": _detail_rows,
    "detail_report_from_facts": lambda t: detail_report(t, *REPORT, facts=_activity(t)),
    "summary_report_open_records": lambda t: summary_report(t, *REPORT),
    "summary_report_from_facts": lambda t: summary_report(t, *REPORT, facts=_activity(t)),
}


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{scratch_folder(spark)}/{name}-{uuid4().hex}"


def _table_page_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = summary_report(SampleTables(spark, sf_dir), *REPORT)
    path = _scratch(spark, "sorted")
    return browse.store_sorted(report, path, ascending=False).page(page=4, size=300)


def _stored_summary(spark: SparkSession, sf_dir: str) -> str:
    report = labeled(summary_report(SampleTables(spark, sf_dir), *REPORT), SUMMARY_LABELS)
    path = _scratch(spark, "summary")
    write_days(report, path, period=PERIOD)
    return path


def _facet_filter_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored_summary(spark, sf_dir)
    stored = read_report(spark, path, SUMMARY_LABELS, "2024-01-05", "2024-01-20")
    return browse.facet_filter(stored, {"department": "machinery"})


def _on_index(use: Callable[[StoredReport], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        stored = StoredReport(spark, _stored_summary(spark, sf_dir), SUMMARY_LABELS)
        stored.index()
        return use(stored)

    return query


_ON_INDEX: dict[str, Callable[[StoredReport], DataFrame]] = {
    "facet_values_indexed": lambda s: s.facet_values(*PERIOD),
    "facet_count_indexed": lambda s: s.count(FACETS, "2024-01-05", "2024-01-20"),
    "facet_filter_indexed": lambda s: s.filter(FACETS, *PERIOD),
    "table_search_indexed": lambda s: s.search(SEARCH, *PERIOD),
}


def _on_sample(query: Callable[[Tables], DataFrame], sample=SampleTables) -> Query:
    return lambda spark, sf_dir: query(sample(spark, sf_dir))


QUERIES: dict[str, Query] = {name: _on_sample(query) for name, query in _ON_TABLES.items()}
QUERIES |= {name: _on_sample(query, HardSampleTables) for name, query in _ON_HARD_TABLES.items()}
QUERIES["table_page_deep"] = _table_page_deep
QUERIES["facet_filter_stored"] = _facet_filter_stored
QUERIES |= {name: _on_index(use) for name, use in _ON_INDEX.items()}
QUERIES["decimal_to_double"] = _decimals

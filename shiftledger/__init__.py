"""Attendance and working-time reports on Spark."""

from shiftledger.plans.reports import detail_report, summary_report
from shiftledger.rules import Rules
from shiftledger.sources.tables import Tables, read_jdbc, read_relations, read_tables

__all__ = [
    "Rules",
    "Tables",
    "detail_report",
    "read_jdbc",
    "read_relations",
    "read_tables",
    "summary_report",
]

"""Size checks that decide between two ways to the same rows."""

from __future__ import annotations

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame

from shiftledger.sources.tables import Tables


def is_broadcastable(df: DataFrame) -> bool:
    """Whether Spark's size estimate of ``df`` is within its broadcast threshold.

    For a file source the estimate comes from the file sizes, without a job.  A
    source of unknown size counts as large, and so does any in a session that
    does not tell its estimates.
    """
    try:
        estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    except (AttributeError, Py4JError):
        return False
    return int(str(estimate)) <= threshold


def has_small_roster(tables: Tables, row_exact: bool = False) -> bool:
    """Whether Spark would broadcast each table of employees, and for ``row_exact`` the others too."""
    used = [tables.employees, tables.employee_attributes]
    if row_exact:
        used += [tables.departments, tables.positions]
    return all(map(is_broadcastable, used))

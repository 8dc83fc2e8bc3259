"""Every registered query against its SQL on the smallest sample."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from catalog.oracles import ORACLES
from catalog.queries import QUERIES, REPORT
from shiftledger import detail_report
from shiftledger.operators.activity import activity
from shiftledger.operators.successors import successors
from shiftledger.sources.sample import HardSampleTables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())


def by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    found = driver.queries()[name](spark, SF_DIR)
    result = database.execute(driver.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    assert sorted(found.columns) == sorted(columns)
    rows = found.collect()
    assert rows
    assert by_name(found.columns, rows) == by_name(columns, result.fetchall())


def test_sort_order_and_page(spark):
    """The SQL comparison ignores row order; these are the queries with one."""
    queries = driver.queries()
    names = [row["full_name"] for row in queries["table_sort"](spark, SF_DIR).collect()]
    texts = [(name or "").lower() for name in names]
    assert texts == sorted(texts, reverse=True)
    logins = [row["login"] or "" for row in queries["table_page"](spark, SF_DIR).collect()]
    assert logins == sorted(logins) and len(logins) == 25


def test_the_hard_sample_is_hard(spark):
    """What the operators drop, join or skip there does occur."""
    tables = HardSampleTables(spark, SF_DIR)
    rows = activity(tables, *REPORT).count()
    assert detail_report(tables, *REPORT).count() > rows
    events = tables.clock_events
    copies = successors(events).filter("is_copy")
    assert copies.count() > copies.filter("next_ts is not null and next_ts <> event_ts").count() > 0
    assert events.filter("employee_id is null").count() > 0
    assert tables.work_records.filter("stop_ts is null").count() > 0
    same_time = events.distinct().groupBy("employee_id", "event_ts").count()
    assert same_time.filter("count > 1").count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() == 2203

"""Filtering, searching, sorting, paging and column widths."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from shiftledger.operators.browse import (
    facet_filter,
    facet_values,
    open_sorted,
    store_sorted,
    table_page,
    table_search,
    table_sort,
)
from shiftledger.operators.widths import column_widths
from shiftledger.session import ensure_checkpoint_dir


@pytest.fixture(scope="module")
def table(spark):
    rows = [("a", "X"), ("b", "x"), ("c", "X+Y"), ("d", None)]
    return spark.createDataFrame(rows, "login string, department string")


def logins(df):
    return [row["login"] for row in df.collect()]


def test_facet_values(table):
    values = [
        r["value"] for r in facet_values(table).collect() if r["column_name"] == "department"
    ]
    assert values == ["", "X", "X+Y", "x"]


def test_facet_filter(table):
    assert sorted(logins(facet_filter(table, {"department": "X"}))) == ["a", "b"]
    assert logins(facet_filter(table, {"department": "X+Y"})) == ["c"]
    assert logins(facet_filter(table, {"department": "X", "login": "b"})) == ["b"]
    assert len(logins(facet_filter(table, {"department": ""}))) == 4


def test_search(table):
    assert logins(table_search(table, "x c")) == ["c"]
    assert sorted(logins(table_search(table, "X"))) == ["a", "b", "c"]
    assert len(logins(table_search(table, ""))) == 4


def test_search_for_a_phrase(spark):
    df = spark.createDataFrame([("Anna Nowak",), ("Nowak Anna",)], "name string")
    assert [r["name"] for r in table_search(df, '"anna nowak"').collect()] == ["Anna Nowak"]
    assert table_search(df, "anna nowak").count() == 2


def test_pages(table):
    assert logins(table_page(table, 1, 3)) == ["a", "b", "c"]
    assert logins(table_page(table, 2, 3)) == ["d"]
    with pytest.raises(ValueError):
        table_page(table, 0)


@pytest.mark.parametrize("ascending", [True, False])
def test_stored_pages_in_order(spark, tmp_path, ascending):
    df = spark.range(1000, numPartitions=7).selectExpr("cast(id % 13 as string) a", "id b")
    pages = []
    store_sorted(df, str(tmp_path), "a", ascending)
    stored = open_sorted(spark, str(tmp_path))
    everything = table_sort(df, "a", ascending).collect()
    assert table_page(df, 2, 120, "a", ascending).collect() == everything[120:240]
    for page in (1, 2, 5, 9, 10, 11):
        top = stored.page(page, 120).collect()
        assert stored.page(page, 120).collect() == top
        if top:
            assert top == everything[(page - 1) * 120 :][:120]
        pages.append(len(top))
    assert pages == [120, 120, 120, 40, 0, 0]


def test_stored_page_reads_only_its_part(spark, table, tmp_path):
    page = store_sorted(table, str(tmp_path)).page(1, 3)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in plan and "TakeOrdered" not in plan
    assert "PushedFilters" in plan
    assert table_page(table, 11, 100).collect() == []


@pytest.fixture(scope="module")
def long_table(spark, tmp_path_factory):
    """Nulls, one text for a third of all rows, repeated rows, texts equal but for case."""
    path = str(tmp_path_factory.mktemp("long") / "t")
    spark.range(120_000, numPartitions=5).selectExpr(
        "if(id % 3 = 0, 'same', if(id % 2 = 0, concat('K', id % 50), concat('k', id % 50))) a",
        "if(id % 11 = 0, null, id % 700) n",
        "if(id % 3 = 0 and id % 5 > 0, null, cast(date_add(date '2024-01-01', cast(id % 900 as int)) as timestamp_ntz)) t",
        "cast(id % 13 as double) / 7 d",
    ).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("column, ascending", [("a", True), ("a", False), ("n", True), ("n", False), ("t", False)])
def test_far_pages_by_rank(long_table, column, ascending):
    everything = table_sort(long_table, column, ascending).collect()
    for page, size in ((1001, 100), (100_001, 1), (23, 1777), (1200, 100), (1201, 100)):
        found = table_page(long_table, page, size, column, ascending)
        assert found.collect() == everything[(page - 1) * size :][:size]


def test_a_far_page_sorts_few_rows(long_table):
    plan = table_page(long_table, 500, 200, "a")._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan and "Window" not in plan


@pytest.mark.parametrize("size", [3, 40_000])
def test_ranks_of_equal_rows_and_wide_pages(spark, size):
    from shiftledger.operators.paging import RankedRows

    df = spark.range(50_000).selectExpr("if(id < 30000, 'x', 'y') a", "if(id = 7, 1, null) b")
    order = [F.col("a").asc_nulls_first(), F.col("b").asc_nulls_first()]
    everything = df.orderBy(*order).collect()
    for first in (0, 29_998, 45_000, 49_999, 50_000):
        found = RankedRows(df, F.col("a"), order, True).page(first, size, limit=10)
        assert found.collect() == everything[first : first + size]


def test_sort(table):
    assert logins(table_sort(table, "department")) == ["d", "a", "b", "c"]
    assert logins(table_sort(table, "department", ascending=False)) == ["c", "a", "b", "d"]


def test_column_widths(spark):
    df = spark.createDataFrame(
        [("a", date(2024, 1, 5), None), ("abcdefg", date(2024, 1, 5), None)],
        "Login string, Data date, `Podsumowanie ` string",
    )
    widths = {r["column_name"]: r["width"] for r in column_widths(df).collect()}
    assert widths == {"Login": 9, "Data": 6, "Podsumowanie ": 15}
    empty = {r["column_name"]: r["width"] for r in column_widths(df.limit(0)).collect()}
    assert empty == {"Login": 7, "Data": 6, "Podsumowanie ": 15}


def test_checkpoint_folder(tmp_path):
    """The cluster's folder is used; without one, only a local session makes its own."""

    class Context:
        def __init__(self, master):
            self.master, self.folder = master, None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        def __init__(self, master, settings):
            self.sparkContext, self.conf = Context(master), settings

    cluster = Session("yarn", {"spark.checkpoint.dir": "hdfs://shared/checkpoints"})
    ensure_checkpoint_dir(cluster)
    assert cluster.sparkContext.folder == "hdfs://shared/checkpoints"
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session("yarn", {}))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session("local-cluster[2,1,1024]", {}))
    local = Session("local[2]", {})
    ensure_checkpoint_dir(local)
    assert local.sparkContext.folder is not None

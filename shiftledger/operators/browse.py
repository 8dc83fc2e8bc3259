"""Filter, search, sort and page a report table, as its web view does.

Text matches ignore case; a null cell reads as the empty text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftledger.functions.text import display_text
from shiftledger.operators.paging import RankedRows

#: Pages that end beyond this many rows are selected by rank.
TOP_ROWS = 1_000
_PART, _ROW = "__part", "__row"


def _cell(name: str) -> Column:
    return display_text(F.col(f"`{name}`"))


def all_cells(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """column_name and value of every cell as text; columns to ``keep`` stand beside each."""
    names = [name for name in df.columns if name not in keep]
    cells = df.select(*keep, *[_cell(name).alias(name) for name in names])
    return cells.unpivot(list(keep), [f"`{name}`" for name in names], "column_name", "value")


def facet_values(df: DataFrame) -> DataFrame:
    """Sorted distinct texts of every column."""
    return all_cells(df).distinct().orderBy("column_name", "value")


def facet_filter(df: DataFrame, choices: dict[str, str]) -> DataFrame:
    """Rows whose cells equal all chosen texts; an empty choice chooses nothing."""
    conditions = [
        F.lower(_cell(name)) == F.lower(F.lit(value)) for name, value in choices.items() if value
    ]
    return df.filter(reduce(lambda a, b: a & b, conditions)) if conditions else df


def search_words(text: str) -> list[str]:
    """The words of a search; a part in double quotes is one phrase."""
    words = [word.strip('"') for word in re.findall(r'"[^"]+"|[^ ]+', text)]
    return [word for word in words if word]


def row_text(df: DataFrame) -> Column:
    """All cells of a row, as a search sees them."""
    return F.lower(F.concat_ws("  ", *[_cell(name) for name in df.columns]))


def table_search(df: DataFrame, text: str) -> DataFrame:
    """Rows that hold every word of ``text`` in some column."""
    row = row_text(df)
    conditions = [F.contains(row, F.lower(F.lit(word))) for word in search_words(text)]
    return df.filter(reduce(lambda a, b: a & b, conditions)) if conditions else df


def _sort_key(df: DataFrame, column: str | None) -> Column:
    name = column or df.columns[0]
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.lower(_cell(name))
    return F.col(f"`{name}`")


def _ordering(df: DataFrame, column: str | None, ascending: bool) -> list[Column]:
    """The chosen column, then all columns as they are to settle ties."""
    key = _sort_key(df, column)
    ties = [F.col(f"`{name}`").asc_nulls_first() for name in df.columns]
    return [key.asc_nulls_first() if ascending else key.desc_nulls_last(), *ties]


def table_sort(df: DataFrame, column: str | None = None, ascending: bool = True) -> DataFrame:
    """Sorted by a column (the first by default), empty cells lowest.

    The tie-breakers are part of the range partitioning, so one frequent value
    does not end up in one task.
    """
    return df.orderBy(*_ordering(df, column, ascending))


def table_page(
    df: DataFrame,
    page: int = 1,
    size: int = 10,
    column: str | None = None,
    ascending: bool = True,
) -> DataFrame:
    """One page of the sorted table.

    Within the first ``TOP_ROWS`` rows a top-k: each task keeps the rows up to the
    end of the page, and no job runs before the result is read.  A further page is
    selected by rank, which runs two jobs over ``df`` a pass; it should be a stored
    table.  For many such pages of one order, ``store_sorted`` sorts once.
    """
    first, end = _bounds(page, size)
    if end > TOP_ROWS:
        ordering = _ordering(df, column, ascending)
        return RankedRows(df, _sort_key(df, column), ordering, ascending).page(first, size)
    return table_sort(df, column, ascending).offset(first).limit(size)


def _bounds(page: int, size: int) -> tuple[int, int]:
    if page < 1 or size < 1:
        raise ValueError("page and size start at 1")
    return (page - 1) * size, page * size


@dataclass(frozen=True)
class SortedTable:
    """A stored copy in order, with the rows before each of its parts."""

    rows: DataFrame
    starts: list[tuple[int, int, int]]

    def page(self, page: int = 1, size: int = 10) -> DataFrame:
        """One page, in order; reads the parts that hold it and runs no job by itself."""
        first, end = _bounds(page, size)
        wanted = F.lit(False)
        for part, before, count in self.starts:
            low, high = max(first - before, 0), min(end - before, count)
            if low < high:
                here = F.col(_PART) == part
                wanted = wanted | (here & F.col(_ROW).between(low, high - 1))
        return self.rows.filter(wanted).orderBy(_PART, _ROW).drop(_PART, _ROW)


def store_sorted(
    df: DataFrame, path: str, column: str | None = None, ascending: bool = True
) -> SortedTable:
    """Sort ``df`` once into ``path``, which is the caller's to keep or remove.

    Runs the sort, and a count with one row per part, which is stored beside.
    """
    (
        table_sort(df, column, ascending)
        .withColumn(_PART, F.spark_partition_id())
        # the id is the partition shifted by 33 bits plus the row in it
        .withColumn(
            _ROW, F.monotonically_increasing_id() - F.shiftleft(F.col(_PART).cast("long"), 33)
        )
        .write.mode("overwrite")
        .parquet(f"{path}/rows")
    )
    spark = df.sparkSession
    counts = spark.read.parquet(f"{path}/rows").groupBy(_PART).count()
    counts.write.mode("overwrite").parquet(f"{path}/counts")
    return open_sorted(spark, path)


def open_sorted(spark: SparkSession, path: str) -> SortedTable:
    """A copy that ``store_sorted`` made; reads one row per part."""
    starts, before = [], 0
    for part, rows in sorted(map(tuple, spark.read.parquet(f"{path}/counts").collect())):
        starts.append((part, before, rows))
        before += rows
    return SortedTable(spark.read.parquet(f"{path}/rows"), starts)

"""Shared folders, written tables and positions for the operators of this package."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftledger.sources.storage import Storage

#: A word: anything between spaces and the control characters tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"

_LOCAL: dict[str, str] = {}
_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the one the cluster names in ``spark.checkpoint.dir``.

    Only a session of one machine without that setting gets a temporary folder
    of its own, which is removed when Python ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _LOCAL.get(context.applicationId)
        if base is None:
            base = _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="shiftledger-llm-")
            atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/{name}-{uuid4().hex}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and kept if executors go."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shuffles_removed(spark: SparkSession) -> AbstractContextManager[None]:
    """Within it, a query's shuffle files go when it ends, not when the driver collects its garbage."""
    return _setting(spark, _SHUFFLES, "true")


def small_batches(spark: SparkSession, size: int) -> AbstractContextManager[None]:
    """Within it, a query hands Python about ``size`` bytes at once, however long the rows are."""
    return _setting(spark, _BATCHES, str(size))


def remove(*tables: DataFrame) -> None:
    """Delete written ``tables`` that are used up."""
    for table in tables:
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            Storage(table.sparkSession, folder).delete("")


def free_name(taken: list[str], name: str) -> str:
    """``name``, lengthened until no column is called so, whatever the case."""
    held = {column.lower() for column in taken}
    while name.lower() in held:
        name += "_"
    return name


def columns_of(df: DataFrame) -> list[Column]:
    """All columns, also those with a dot in their name."""
    return [F.col(f"`{name.replace('`', '``')}`") for name in df.columns]


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, even if ``use`` repeats it for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def small_frame(spark: SparkSession, columns: dict[str, pa.Array]) -> DataFrame:
    """A frame of a few rows held by the driver, without Python workers."""
    return spark.createDataFrame(pa.table(columns))


def with_position(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """Rows numbered from 0 in ``order``.

    A range sort and one count per partition; no task sees more than its range.
    The driver gets one row per partition.
    """
    part, row = "__part", "__row"
    placed = written(
        df.orderBy(*order)
        .withColumn(part, F.spark_partition_id())
        # the id is the partition shifted by 33 bits plus the row in it
        .withColumn(
            row, F.monotonically_increasing_id() - F.shiftleft(F.col(part).cast("long"), 33)
        ),
        "positions",
    )
    counts = placed.groupBy(part).agg((F.max(row) + 1).alias("rows")).collect()
    parts, before, offsets = [], 0, []
    for number, rows in sorted((r[part], r["rows"]) for r in counts):
        parts.append(number)
        offsets.append(before)
        before += rows
    starts = small_frame(
        df.sparkSession,
        {part: pa.array(parts, pa.int32()), "__start": pa.array(offsets, pa.int64())},
    )
    return placed.join(F.broadcast(starts), part).select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("__start") + F.col(row)).alias(name)
    )

"""Report writers.  Rows go from the executors to storage; none to the driver.

A stored report has a folder per day, and in it one per run that wrote the day.
A commit, written last, names the run that is live for each day; readers go by the
newest complete commit.  So a run that dies at any point leaves the report as it
was, and runs over the same days follow one another.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftledger.functions.clock import as_day, day_literal
from shiftledger.session import scratch_folder
from shiftledger.sources.storage import Storage

#: Folders that Spark's readers pass over.
_COMMITS = "_commits"
RUN = "__run"


@dataclass(frozen=True)
class Commit:
    """What is live: the run of each day folder, and the columns."""

    number: int = 0
    runs: dict[str, str] = field(default_factory=dict)
    schema: str | None = None

    def folders(self, days: tuple[date | str, date | str] | None = None) -> list[str]:
        """The live folders, of all days or of a period."""
        chosen = self.runs if days is None else [f for f in self.runs if _in_period(f, days)]
        return [f"{folder}/{RUN}={self.runs[folder]}" for folder in chosen]

    def columns(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


def _in_period(folder: str, days: tuple[date | str, date | str]) -> bool:
    """Whether the folder of a day lies in the period; one of no day does not."""
    try:
        day = date.fromisoformat(unquote(folder.split("=", 1)[1]))
    except ValueError:
        return False
    first, last = map(as_day, days)
    return first <= day <= last


def _numbers(storage: Storage) -> list[int]:
    names = (name.rsplit("/", 1)[-1].split(".") for name in storage.names(_COMMITS))
    return sorted(int(name[0]) for name in names if name[0].isdigit() and name[-1] == "json")


def _commit_file(number: int) -> str:
    return f"{_COMMITS}/{number:012d}.json"


def newest_commit(storage: Storage) -> Commit:
    """The newest commit that was written to its end, or an empty one."""
    for number in reversed(_numbers(storage)):
        try:
            held = json.loads(storage.read(_commit_file(number)))
            return Commit(number, held["runs"], held["schema"])
        except (ValueError, KeyError):
            continue
    return Commit()


def _publish(
    storage: Storage, run: str, written: Iterable[str], schema: str, period: tuple[date | str, date | str] | None
) -> tuple[Commit, Commit]:
    """Make the written days live.  Another run's commit in between is built upon, not lost."""
    while True:
        before = newest_commit(storage)
        kept = {f: r for f, r in before.runs.items() if period is None or not _in_period(f, period)}
        runs = kept | dict.fromkeys(written, run)
        number = max([0, *_numbers(storage)]) + 1
        after = Commit(number, runs, schema)
        if storage.create(_commit_file(number), json.dumps({"runs": runs, "schema": schema})):
            return before, after


def write_days(
    df: DataFrame,
    path: str,
    day: str = "Data",
    fmt: str = "parquet",
    period: tuple[date | str, date | str] | None = None,
    clear: bool = True,
) -> None:
    """One directory per day; a rerun replaces the days it writes.

    With ``period``, the first and last day of the report, stored days of the
    period that have no rows any more are removed as well.  Rebalancing by day
    gives few files for a small day and splits a large one.  What a commit
    replaced is deleted after it, or stays for running readers until
    ``clear_report`` if ``clear`` is off.
    """
    storage, run = Storage(df.sparkSession, path), uuid4().hex
    (
        df.withColumn(RUN, F.lit(run))
        .hint("rebalance", F.col(f"`{day}`"))
        .write.format(fmt)
        .mode("append")
        .partitionBy(day, RUN)
        .save(storage.root)
    )
    written = [name.split("/")[0] for name in storage.matching(f"*/{RUN}={run}")]
    before, after = _publish(storage, run, written, df.schema.json(), period)
    if clear:
        live = set(after.folders())
        for folder in before.folders():
            if folder not in live:
                _remove(storage, folder)


def _remove(storage: Storage, folder: str) -> None:
    storage.delete(folder)
    above = folder.split("/")[0]
    if not storage.names(above):
        storage.delete(above)


def clear_report(spark: SparkSession, path: str) -> list[str]:
    """Delete the folders of runs that are not live, also those of runs that died; returns them.

    For times when nothing writes the report or reads an earlier state of it.
    """
    storage = Storage(spark, path)
    live = set(newest_commit(storage).folders())
    dead = [name for name in storage.matching(f"*/{RUN}=*") if name not in live]
    for folder in dead:
        _remove(storage, folder)
    return dead


def live_rows(
    spark: SparkSession,
    storage: Storage,
    commit: Commit,
    names: list[str],
    fmt: str = "parquet",
) -> DataFrame:
    """The rows in ``names``, live folders or files of them, with their day and run."""
    schema = commit.columns().add(RUN, "string")
    if not names:
        return spark.createDataFrame([], schema)
    reader = spark.read.format(fmt).schema(schema).option("basePath", storage.root)
    return reader.load([f"{storage.root}/{name}" for name in names])


def read_report(
    spark: SparkSession,
    path: str,
    labels: dict[str, str],
    from_day: date | str,
    to_day: date | str,
    day: str = "day",
    fmt: str = "parquet",
) -> DataFrame:
    """Days of a report that ``write_days`` stored, under the names ``labels`` were given to.

    Only the live directories of the days are read.
    """
    storage = Storage(spark, path)
    commit = newest_commit(storage)
    if commit.schema is None:
        raise FileNotFoundError(f"no report was committed to {storage.root}")
    stored = live_rows(spark, storage, commit, commit.folders((from_day, to_day)), fmt)
    named = stored.select(*[F.col(f"`{label}`").alias(name) for name, label in labels.items()])
    return named.filter(F.col(day).between(day_literal(from_day), day_literal(to_day)))


def export_csv(df: DataFrame, directory: str, one_file: bool = True) -> str:
    """A CSV copy with header under a name of its own; returns its path.

    ``one_file`` writes a single file in the order of ``df``: the rows are computed
    by all tasks and kept, numbered, as a table in the scratch folder; one task then sorts
    them by number and writes.  Without it there is a file per partition, each with
    the header.  Quotes are doubled, as other CSV readers expect; for Spark's
    reader set ``escape`` to a quote and ``multiLine``.
    """
    path = f"{directory}/report-{uuid4()}"
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    if not one_file:
        df.write.options(**options).csv(path)
        return path
    spark, number = df.sparkSession, "__number"
    scratch = Storage(spark, f"{scratch_folder(spark)}/export-{uuid4().hex}")
    # ids ascend by partition and within it
    df.withColumn(number, F.monotonically_increasing_id()).write.parquet(scratch.root)
    kept = spark.read.schema(T.StructType([*df.schema.fields, T.StructField(number, T.LongType())])).parquet(scratch.root)
    kept.repartition(1).sortWithinPartitions(number).drop(number).write.options(**options).csv(path)
    scratch.delete("")
    return path

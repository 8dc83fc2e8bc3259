"""An index beside a stored report, for browsing without reading the report.

Per day that is live it holds

* a dictionary: every column's distinct texts with their number of rows;
* row numbers in the files per text: bitmaps where it is frequent, lists where it is rare;
* an inverted index: which files hold which three-letter pieces of row texts.

``index`` adds what is missing, so a rewritten day gets an index of its own and
the others keep theirs.  An index run is read only after the file that says what it
covers, written last; a live day without an index makes the readers raise.
"""

from __future__ import annotations

import json
from datetime import date
from functools import reduce
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftledger.operators.browse import all_cells, facet_filter, row_text, search_words, table_search
from shiftledger.sources.sinks import RUN, Commit, live_rows, newest_commit, read_report
from shiftledger.sources.storage import Storage

_INDEX = "_index"
_READY = "ready.json"
#: Rows of a day from which a text gets bitmaps.
DENSE = 1024
#: Letters of a piece.
PIECE = 3
_PART, _NUMBER, _FILE = "__part", "__number", "__file"
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"
_SCHEMAS = {
    "cells": "part int, column_name string, value string, found long",
    "bitmaps": "part int, file string, column_name string, value string, bucket long, bits binary",
    "numbers": "part int, file string, column_name string, value string, numbers array<long>",
    "pieces": "part int, file string, piece string",
}

Period = tuple[date | str, date | str]


def _pieces(letters: Column) -> Column:
    """The different runs of ``PIECE`` neighbouring letters."""
    starts = F.when(F.size(letters) >= PIECE, F.sequence(F.lit(0), F.size(letters) - PIECE))
    runs = F.transform(starts, lambda at: F.concat(*[F.get(letters, at + n) for n in range(PIECE)]))
    return F.array_distinct(F.coalesce(runs, F.array().cast("array<string>")))


def _with_letters(df: DataFrame, text: Column) -> DataFrame:
    return df.withColumn("letters", F.split(text, ""))


class StoredReport:
    """A Parquet report that ``write_days`` stored, under the names ``labels`` were given to."""

    def __init__(self, spark: SparkSession, path: str, labels: dict[str, str], day: str = "day") -> None:
        self._spark, self._path, self._labels, self._day = spark, path, labels, day
        self._storage = Storage(spark, path)

    def _named(self, stored: DataFrame, *more: Column) -> DataFrame:
        columns = [F.col(f"`{label}`").alias(name) for name, label in self._labels.items()]
        return stored.select(*columns, *more)

    def _indexed(self) -> dict[str, tuple[str, int]]:
        """Index run and part of every folder that has an index."""
        found = {}
        for run in self._storage.names(_INDEX):
            if f"{run}/{_READY}" in self._storage.names(run):
                held = json.loads(self._storage.read(f"{run}/{_READY}"))
                if held["columns"] == list(self._labels):
                    found |= {folder: (run, part) for folder, part in held["parts"].items()}
        return found

    def index(self, dense: int = DENSE) -> None:
        """Index the live days that have no index yet, and drop the index of days that are gone."""
        commit, indexed = newest_commit(self._storage), self._indexed()
        live = commit.folders()
        missing = [folder for folder in live if folder not in indexed]
        if missing:
            self._write_index(commit, missing, dense)
        used = {indexed[folder][0] for folder in live if folder in indexed}
        for run in {run for run, _ in indexed.values()} - used:
            self._storage.delete(run)

    def _write_index(self, commit: Commit, folders: list[str], dense: int) -> None:
        spark, name = self._spark, f"{_INDEX}/{uuid4().hex}"
        days = [folder.split("/")[0].split("=", 1)[1] for folder in folders]
        parts = spark.createDataFrame(
            pa.table(
                {
                    "held_day": [None if day == _NO_DAY else day for day in days],
                    "held_run": [folder.rsplit("=", 1)[1] for folder in folders],
                    _PART: pa.array(range(len(folders)), pa.int32()),
                }
            )
        )
        stored = live_rows(spark, self._storage, commit, folders)
        day = F.col(f"`{self._labels[self._day]}`").cast("string")
        file = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
        extra = [day.alias("held_day"), F.col(RUN).alias("held_run"), file.alias(_FILE)]
        rows = self._named(stored, *extra, F.col("_metadata.row_index").alias(_NUMBER))
        same = rows["held_day"].eqNullSafe(parts["held_day"]) & (rows["held_run"] == parts["held_run"])
        # a row per folder of this run
        rows = rows.join(F.broadcast(parts), same).drop("held_day", "held_run")

        cells = all_cells(rows, (_PART, _FILE, _NUMBER)).withColumnRenamed(_FILE, "file")
        key = [_PART, "column_name", "value"]
        self._store(cells.groupBy(*key).agg(F.count(F.lit(1)).alias("found")), name, "cells")
        counted = self._spark.read.schema(_SCHEMAS["cells"]).parquet(f"{self._storage.root}/{name}/cells")
        frequent = counted.filter(F.col("found") >= dense).select(F.col("part").alias(_PART), *key[1:])
        bits = F.bitmap_construct_agg(F.bitmap_bit_position(_NUMBER)).alias("bits")
        bucket = F.bitmap_bucket_number(F.col(_NUMBER)).alias("bucket")
        self._store(cells.join(frequent, key).groupBy(*key, "file", bucket).agg(bits), name, "bitmaps")
        rare = cells.join(frequent, key, "left_anti")
        self._store(rare.groupBy(*key, "file").agg(F.collect_list(_NUMBER).alias("numbers")), name, "numbers")

        text = row_text(rows.drop(_PART, _FILE, _NUMBER))
        lettered = _with_letters(rows.select(_PART, F.col(_FILE).alias("file"), text.alias("text")), F.col("text"))
        pieces = lettered.select(_PART, "file", F.explode(_pieces(F.col("letters"))).alias("piece")).distinct()
        self._store(pieces, name, "pieces")
        held = {"columns": list(self._labels), "parts": {folder: n for n, folder in enumerate(folders)}}
        self._storage.create(f"{name}/{_READY}", json.dumps(held))

    def _store(self, df: DataFrame, name: str, kind: str) -> None:
        """A folder per part, so that a period reads its own."""
        df = df.withColumn("part", F.col(_PART)).hint("rebalance", F.col(_PART))
        ordered = df.sortWithinPartitions(_PART, *[c for c in ("piece", "column_name", "value") if c in df.columns])
        ordered.write.partitionBy(_PART).parquet(f"{self._storage.root}/{name}/{kind}")

    def _table(self, kind: str, period: Period) -> DataFrame:
        """The index of the live days in the period, with the folder each row is about."""
        commit, indexed = newest_commit(self._storage), self._indexed()
        folders = commit.folders(period)
        if stale := [folder for folder in folders if folder not in indexed]:
            raise LookupError(f"not indexed yet: {', '.join(stale[:3])}")
        runs: dict[str, dict[int, str]] = {}
        for folder in folders:
            run, part = indexed[folder]
            runs.setdefault(run, {})[part] = folder
        spark, tables = self._spark, []
        for run, parts in runs.items():
            # a part without rows of this kind has no folder
            present = set(self._storage.names(f"{run}/{kind}"))
            paths = [f"{run}/{kind}/{_PART}={part}" for part in parts]
            paths = [f"{self._storage.root}/{path}" for path in paths if path in present]
            if paths:
                names = pa.table({"part": pa.array(list(parts), pa.int32()), "folder": list(parts.values())})
                held = spark.read.schema(_SCHEMAS[kind]).parquet(*paths)
                tables.append(held.join(F.broadcast(spark.createDataFrame(names)), "part"))
        empty = spark.createDataFrame([], f"{_SCHEMAS[kind]}, folder string")
        return reduce(DataFrame.unionByName, tables, empty)

    def rows(self, from_day: date | str, to_day: date | str) -> DataFrame:
        return read_report(self._spark, self._path, self._labels, from_day, to_day, self._day)

    def facet_values(self, from_day: date | str, to_day: date | str) -> DataFrame:
        """``browse.facet_values`` with the number of rows, from the dictionaries."""
        cells = self._table("cells", (from_day, to_day))
        counted = cells.groupBy("column_name", "value").agg(F.sum("found").alias("found"))
        return counted.orderBy("column_name", "value")

    def _matches(self, choices: dict[str, str], period: Period) -> DataFrame:
        """Per folder and bucket of row numbers the bits of the rows that all choices hold for."""
        wanted = F.lit(False)
        for name, value in choices.items():
            wanted = wanted | ((F.col("column_name") == name) & (F.lower("value") == F.lower(F.lit(value))))
        place = ["folder", "file", "bucket"]
        key = [*place, "column_name"]
        dense = self._table("bitmaps", period).filter(wanted).select(*key, "bits")
        rare = self._table("numbers", period).filter(wanted).select("folder", "file", "column_name", F.explode("numbers").alias("number"))
        bits = F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
        bucket = F.bitmap_bucket_number(F.col("number")).alias("bucket")
        rare = rare.groupBy("folder", "file", bucket, "column_name").agg(bits).select(*key, "bits")
        # texts that differ in case are one choice
        chosen = dense.unionByName(rare).groupBy(*key).agg(F.bitmap_or_agg("bits").alias("bits"))
        both = chosen.groupBy(*place).agg(
            F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("choices")
        )
        found = F.bitmap_count("bits").alias("found")
        return both.filter(F.col("choices") == len(choices)).select("folder", "file", found).filter("found > 0")

    def count(self, choices: dict[str, str], from_day: date | str, to_day: date | str) -> DataFrame:
        """``found``, the number of rows ``browse.facet_filter`` would keep; reads no row of the report."""
        choices, period = {name: value for name, value in choices.items() if value}, (from_day, to_day)
        if not choices:
            cells = self._table("cells", period).filter(F.col("column_name") == self._day)
            return cells.agg(F.coalesce(F.sum("found"), F.lit(0)).alias("found"))
        return self._matches(choices, period).agg(F.coalesce(F.sum("found"), F.lit(0)).alias("found"))

    def filter(self, choices: dict[str, str], from_day: date | str, to_day: date | str) -> DataFrame:
        """``browse.facet_filter``, reading the files that hold a match only."""
        choices = {name: value for name, value in choices.items() if value}
        if not choices:
            return self.rows(from_day, to_day)
        return facet_filter(self._in_files(self._matches(choices, (from_day, to_day))), choices)

    def _in_files(self, chosen: DataFrame) -> DataFrame:
        """Rows of the files (folder, file); the driver gets their names, as it does for any scan."""
        names = sorted(f"{row['folder']}/{row['file']}" for row in chosen.select("folder", "file").distinct().collect())
        return self._named(live_rows(self._spark, self._storage, newest_commit(self._storage), names))

    def search(self, text: str, from_day: date | str, to_day: date | str) -> DataFrame:
        """``browse.table_search``, reading the files only that hold every piece of every word.

        Words shorter than a piece rule no file out.
        """
        words = search_words(text)
        if not words:
            return self.rows(from_day, to_day)
        # lower-cased by Spark, as the texts of the rows are
        listed = self._spark.createDataFrame(pa.table({"word": words})).select(F.lower("word").alias("word"))
        wanted = _with_letters(listed, F.col("word")).select(F.explode(_pieces(F.col("letters"))).alias("piece"))
        pieces = [row["piece"] for row in wanted.distinct().collect()]
        if not pieces:
            return table_search(self.rows(from_day, to_day), text)
        held = self._table("pieces", (from_day, to_day)).filter(F.col("piece").isin(pieces))
        files = held.groupBy("folder", "file").agg(F.count(F.lit(1)).alias("found"))
        return table_search(self._in_files(files.filter(F.col("found") == len(pieces))), text)

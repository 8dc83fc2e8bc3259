"""Readers, writers and the command line."""

import csv
import os
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shiftledger import read_jdbc, read_relations, read_tables, summary_report
from shiftledger.__main__ import main
from shiftledger.operators.activity import event_intervals
from shiftledger.operators.labels import DETAIL_LABELS, SUMMARY_LABELS, labeled
from shiftledger.operators.rollup import MEMBER
from shiftledger.sources.schemas import RELATION_COLUMNS, RELATIONS, SCHEMAS
from shiftledger.sources import sinks
from shiftledger.sources.sinks import clear_report, export_csv, read_report, write_days
from shiftledger.sources.storage import Storage
from shiftledger.sources.tables import conform, decimals_as_double, slice_predicates
from tests.build import event, make_tables, person, work

DAY, NEXT_DAY = "2024-01-05", "2024-01-06"
AS_OF = "2024-01-06 13:00:00"


@pytest.fixture(scope="module")
def tables(spark):
    return make_tables(
        spark,
        [
            work(1, "05:30", "14:00"),
            work(2, "07:00", "12:00"),
            work(1, f"{NEXT_DAY} 05:00", f"{NEXT_DAY} 13:30"),
        ],
        [event(1, 1, 3, "10:00"), event(1, 2, 4, "10:15")],
        [person(1, "a"), person(2, "b", "Żaneta", "Łoś")],
        [(1, "B1", "X", "F", "HC", "P")],
    )


@pytest.fixture(scope="module")
def stored(tables, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    for name in SCHEMAS:
        df = getattr(tables, name)
        if name in ("work_records", "clock_events"):
            column = "start_ts" if name == "work_records" else "event_ts"
            df = df.withColumn("day", F.col(column).cast("date"))
            df.write.partitionBy("day").parquet(f"{root}/{name}")
        else:
            df.write.parquet(f"{root}/{name}")
    return str(root)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partitioned_tables_give_the_same_report(spark, tables, stored):
    period = (DAY, NEXT_DAY, AS_OF)
    expected = rows_of(summary_report(tables, *period))
    assert rows_of(summary_report(read_tables(spark, stored, day_partition="day"), *period)) == expected


def test_day_range_prunes_partitions_and_reaches_the_scan(spark, stored):
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    plan = plan_of(summary_report(
        read_tables(spark, stored, day_partition="day"), DAY, DAY, AS_OF, split_hot=False)
    )
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [(isnull(cast(day" in plan or "PartitionFilters: [(isnull(day" in plan
    assert "GreaterThanOrEqual(event_ts,2024-01-05T00:00)" in plan
    assert "LessThan(event_ts,2024-01-06T00:00)" in plan
    assert "GreaterThanOrEqual(start_ts,2024-01-05T00:00)" in plan
    # hours and engagement are not part of the report
    read = "employee_id:bigint,start_ts:timestamp_ntz,stop_ts:timestamp_ntz,flags:int"
    assert f"ReadSchema: struct<{read}>" in plan


def test_orc_tables(spark, tables, tmp_path):
    for name in SCHEMAS:
        getattr(tables, name).write.orc(f"{tmp_path}/{name}")
    period = (DAY, NEXT_DAY, AS_OF)
    found = rows_of(summary_report(read_tables(spark, str(tmp_path), "orc"), *period))
    assert found == rows_of(summary_report(tables, *period))


def database_frame(tables, relation):
    """The table as the database names and types it."""
    name = next(table for table, source in RELATIONS.items() if source == relation)
    df = getattr(tables, name)
    renamed = df.select(*[F.col(new).alias(old) for new, old in RELATION_COLUMNS[name].items()])
    if name == "work_records":
        return renamed.withColumn("pra_rbh", F.col("pra_rbh").cast("decimal(12,4)"))
    return renamed


def test_database_relations(tables):
    named = read_relations(lambda relation: database_frame(tables, relation))
    for name in SCHEMAS:
        assert getattr(named, name).schema == SCHEMAS[name]
    period = (DAY, NEXT_DAY, AS_OF)
    assert rows_of(summary_report(named, *period)) == rows_of(summary_report(tables, *period))


def test_jdbc_reads_fact_tables_in_time_slices(tables):
    """The arguments of the reads only; there is no database to read from."""
    calls = {}

    class Reader:
        def jdbc(self, url, table, predicates=None, properties=None):
            calls[table] = (url, predicates, properties)
            return database_frame(tables, table)

    class Session:
        read = Reader()

    read_jdbc(Session(), "jdbc:postgresql://db/x", DAY, NEXT_DAY, {"user": "u"}, slices=8)
    assert set(calls) == set(RELATIONS.values())
    url, predicates, properties = calls["tb_rcp_wydarzenia"]
    assert url == "jdbc:postgresql://db/x"
    assert properties == {"preferTimestampNTZ": "true", "user": "u"}
    assert len(predicates) == 8
    assert len(calls["tg_praceall"][1]) == 8
    assert calls["tb_pracownicy"][1] is None
    assert len(slice_predicates("t", "2014-01-01", "2023-12-31", 64)) == 64


def test_time_slices_cover_the_days_once(spark):
    moments = [
        datetime(2024, 1, 4, 23, 59, 59),
        datetime(2024, 1, 5),
        datetime(2024, 1, 5, 6),
        datetime(2024, 1, 6, 23, 59, 59, 999999),
        datetime(2024, 1, 7),
    ]
    df = spark.createDataFrame([(m,) for m in moments], "t timestamp_ntz")
    df.createOrReplaceTempView("moments")
    found = []
    for predicate in slice_predicates("t", DAY, NEXT_DAY, 7):
        spark_text = predicate.replace("timestamp '", "timestamp_ntz '")
        rows = spark.sql(f"SELECT t FROM moments WHERE {spark_text}").collect()
        found += [row["t"] for row in rows]
    assert sorted(found) == moments[1:4]
    with pytest.raises(ValueError):
        slice_predicates("t", DAY, DAY, 0)


def test_decimals_as_double(spark):
    df = spark.createDataFrame([(Decimal("1.25"), "x"), (None, "y")], "a decimal(6,2), b string")
    converted = decimals_as_double(df)
    assert converted.dtypes == [("a", "double"), ("b", "string")]
    assert rows_of(converted) == [(1.25, "x"), (None, "y")]


def test_labels(tables):
    summary = labeled(summary_report(tables, DAY, DAY, AS_OF), SUMMARY_LABELS)
    assert len(DETAIL_LABELS) == 13
    assert len(SUMMARY_LABELS) == 19
    assert summary.columns[-1] == "Podsumowanie "
    assert list(SUMMARY_LABELS)[: len(MEMBER)] == MEMBER


def test_rewriting_a_day_keeps_the_others(spark, tables, tmp_path):
    path = str(tmp_path / "summary")
    write_days(labeled(summary_report(tables, DAY, NEXT_DAY, AS_OF), SUMMARY_LABELS), path)
    write_days(labeled(summary_report(tables, DAY, DAY, AS_OF), SUMMARY_LABELS), path)
    found = spark.read.parquet(path).groupBy("Data").count().collect()
    assert sorted((str(r["Data"]), r["count"]) for r in found) == [(DAY, 2), (NEXT_DAY, 1)]
    names = {r["Imię i Nazwisko"] for r in spark.read.parquet(path).collect()}
    assert names == {"A A", "Żaneta Łoś"}


def test_csv_exports_do_not_collide(tables, tmp_path):
    report = labeled(summary_report(tables, DAY, DAY, AS_OF), SUMMARY_LABELS)
    paths = {export_csv(report, str(tmp_path)) for _ in range(2)}
    assert len(paths) == 2
    for path in paths:
        (part,) = Path(path).glob("*.csv")
        with part.open(encoding="utf-8", newline="") as lines:
            header, *rows = csv.reader(lines)
        assert header == list(SUMMARY_LABELS.values())
        assert sorted(row[0] for row in rows) == ["a", "b"]


def test_command_line(spark, tables, stored, tmp_path, capsys):
    out = str(tmp_path / "out")
    main([DAY, "--to", NEXT_DAY, "--as-of", AS_OF, "--tables", stored, "--out", out, "--csv"])
    assert spark.read.parquet(f"{out}/detail").count() == 5
    assert spark.read.parquet(f"{out}/summary").count() == 3
    exported = capsys.readouterr().out.strip().splitlines()[-1]
    assert spark.read.option("header", True).csv(exported).count() == 3


def test_a_column_called_day_drops_nothing(spark, tmp_path):
    """Ingest days: another day, the day itself, none."""
    events = [
        (1, datetime(2024, 1, 5, 8), 1, 1, datetime(2024, 1, 6).date()),
        (2, datetime(2024, 1, 5, 9), 1, 1, datetime(2024, 1, 5).date()),
        (3, datetime(2024, 1, 5, 10), 1, 1, None),
    ]
    schema = "event_id long, event_ts timestamp_ntz, event_type int, employee_id long, day date"
    df = conform(spark.createDataFrame(events, schema), "clock_events")
    found = event_intervals(df, DAY, DAY, "2024-01-05 12:00:00").orderBy("event_id").collect()
    assert [row["stop_ts"].hour for row in found] == [9, 10, 12]


def test_null_partitions_are_read(spark):
    events = [(1, datetime(2024, 1, 5, 8), 1, 1, None), (2, datetime(2024, 1, 5, 9), 1, 1, datetime(2024, 1, 5).date())]
    schema = "event_id long, event_ts timestamp_ntz, event_type int, employee_id long, p date"
    df = conform(spark.createDataFrame(events, schema), "clock_events", day_partition="p")
    assert event_intervals(df, DAY, DAY, "2024-01-05 12:00:00").count() == 2


def test_instants_mean_the_same_in_every_session_zone(spark, tables, tmp_path):
    moments = spark.createDataFrame([(1, 1704412800000000, 1, 1)], "event_id long, us long, event_type int, employee_id long")
    moments.selectExpr("event_id", "timestamp_micros(us) as event_ts", "event_type", "employee_id").write.parquet(f"{tmp_path}/e")
    before, seen = spark.conf.get("spark.sql.session.timeZone"), set()
    try:
        for zone in ("UTC", "Europe/Warsaw", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            source = spark.read.parquet(f"{tmp_path}/e")
            with pytest.raises(ValueError, match="source_zone"):
                conform(source, "clock_events")
            row = conform(source, "clock_events", source_zone="Europe/Warsaw").first()
            seen.add(row["event_ts"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert seen == {datetime(2024, 1, 5, 1)}


def test_a_report_time_with_an_offset_is_refused(tables):
    with pytest.raises(ValueError, match="offset"):
        summary_report(tables, DAY, DAY, "2024-01-05T12:00:00+05:00")


def test_an_emptied_day_disappears(spark, tmp_path):
    def report(days):
        return spark.createDataFrame([(d, n) for n, d in enumerate(days)], "d string, n int").selectExpr("cast(d as date) as Data", "n")

    path = str(tmp_path / "r")
    write_days(report(["2024-01-04", DAY, NEXT_DAY]), path)
    write_days(report([DAY]), path, period=(DAY, NEXT_DAY))
    assert sorted(str(r["Data"]) for r in spark.read.parquet(path).collect()) == ["2024-01-04", DAY]
    write_days(report([]), path, period=(DAY, NEXT_DAY))
    assert [str(r["Data"]) for r in spark.read.parquet(path).collect()] == ["2024-01-04"]


def test_csv_text_survives(spark, tmp_path):
    texts = ['a"b', "a\\b", 'x\\"y', "p,q", "two\nlines", '"', "żółć"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(3)
    (part,) = Path(export_csv(df, str(tmp_path))).glob("*.csv")
    with part.open(encoding="utf-8", newline="") as lines:
        header, *rows = csv.reader(lines)
    assert sorted(r[0] for r in rows) == sorted(texts)
    assert len(list(Path(export_csv(df, str(tmp_path), one_file=False)).glob("*.csv"))) > 1


def test_stored_report_reads_back_by_day(spark, tables, tmp_path):
    path = str(tmp_path / "summary")
    report = summary_report(tables, DAY, NEXT_DAY, AS_OF)
    write_days(labeled(report, SUMMARY_LABELS), path)
    back = read_report(spark, path, SUMMARY_LABELS, NEXT_DAY, NEXT_DAY)
    assert back.columns == report.columns
    assert rows_of(back) == rows_of(report.filter(F.col("day") == NEXT_DAY))
    assert "PartitionFilters: [isnotnull(Data" in plan_of(back)


def days_of(spark, rows):
    return spark.createDataFrame(rows, "d string, n int").selectExpr("cast(d as date) as Data", "n")


def stored_rows(spark, path):
    read = read_report(spark, path, {"day": "Data", "n": "n"}, "2024-01-01", "2024-12-31")
    return sorted((str(r["day"]), r["n"]) for r in read.collect())


@pytest.mark.parametrize("step", ["_publish", "_remove"])
def test_a_run_that_dies_leaves_a_report(spark, tmp_path, monkeypatch, step):
    """Before the commit the old one, after it the new one, whatever lies around."""
    path = str(tmp_path / "r")
    write_days(days_of(spark, [(DAY, 1), (NEXT_DAY, 2)]), path)
    with monkeypatch.context() as patched:
        patched.setattr(sinks, step, lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError, match="died"):
            write_days(days_of(spark, [(DAY, 3)]), path)
    expected = [(DAY, 1 if step == "_publish" else 3), (NEXT_DAY, 2)]
    assert stored_rows(spark, path) == expected
    assert len(clear_report(spark, path)) == 1 and clear_report(spark, path) == []
    assert stored_rows(spark, path) == expected
    write_days(days_of(spark, [(DAY, 4)]), path)
    assert stored_rows(spark, path) == [(DAY, 4), (NEXT_DAY, 2)]
    assert spark.read.parquet(path).count() == 2


def test_a_commit_cut_short_does_not_count(spark, tmp_path):
    path = str(tmp_path / "r")
    write_days(days_of(spark, [(DAY, 1)]), path)
    Storage(spark, path).create("_commits/000000000002.json", '{"runs": {')
    assert stored_rows(spark, path) == [(DAY, 1)]
    write_days(days_of(spark, [(DAY, 2)]), path)
    assert stored_rows(spark, path) == [(DAY, 2)]


def test_commits_of_two_runs_are_both_kept(spark, tmp_path, monkeypatch):
    """A run that commits between another's reading and commit is built upon."""
    path, create, other = str(tmp_path / "r"), Storage.create, []

    def late(self, name, text):
        if not other:
            other.append(True)
            write_days(days_of(spark, [(NEXT_DAY, 2)]), path)
        return create(self, name, text)

    monkeypatch.setattr(Storage, "create", late)
    write_days(days_of(spark, [(DAY, 1)]), path)
    assert stored_rows(spark, path) == [(DAY, 1), (NEXT_DAY, 2)]


def test_earlier_runs_can_stay_for_readers(spark, tmp_path):
    path = str(tmp_path / "r")
    write_days(days_of(spark, [(DAY, 1)]), path)
    reader = read_report(spark, path, {"day": "Data", "n": "n"}, DAY, DAY)
    write_days(days_of(spark, [(DAY, 2)]), path, clear=False)
    assert [r["n"] for r in reader.collect()] == [1]
    assert stored_rows(spark, path) == [(DAY, 2)]


def test_paths_are_sparks_own(spark, tmp_path):
    """A relative path, and a scheme that only Spark's file systems know."""
    settings = spark._jsc.hadoopConfiguration()
    settings.set("fs.viewfs.mounttable.ledger.link./reports", f"file://{tmp_path}")
    relative = os.path.relpath(tmp_path / "relative")
    for path in (relative, "viewfs://ledger/reports/r", f"file:{tmp_path}/plain"):
        write_days(days_of(spark, [(DAY, 1), (NEXT_DAY, 2)]), path)
        write_days(days_of(spark, [(DAY, 3)]), path, period=(DAY, NEXT_DAY))
        assert stored_rows(spark, path) == [(DAY, 3)]
        assert len(spark.read.parquet(path).inputFiles()) == 1


def test_no_report_and_no_days(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        stored_rows(spark, str(tmp_path / "none"))
    write_days(days_of(spark, []), str(tmp_path / "empty"))
    assert stored_rows(spark, str(tmp_path / "empty")) == []


def test_a_row_without_a_day_is_stored(spark, tmp_path):
    path = str(tmp_path / "r")
    write_days(days_of(spark, [(None, 1), (DAY, 2)]), path)
    write_days(days_of(spark, [(DAY, 3)]), path, period=(DAY, DAY))
    assert sorted(r["n"] for r in spark.read.parquet(path).collect()) == [1, 3]


def test_one_file_keeps_the_order_and_the_tasks(spark, tmp_path):
    df = spark.range(1000, numPartitions=7).selectExpr("cast((id * 37) % 1000 as string) a").orderBy("a")
    (part,) = Path(export_csv(df, str(tmp_path))).glob("*.csv")
    assert part.read_text().split() == ["a", *sorted(map(str, range(1000)))]

"""The index of a stored report gives what a scan gives."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from shiftledger.operators.browse import facet_filter, facet_values, table_search
from shiftledger.sources.report_index import StoredReport
from shiftledger.sources.sinks import write_days

FIRST, LAST = "2024-01-01", "2024-01-09"
LABELS = {"login": "Login", "day": "Data", "name": "Imię i Nazwisko", "team": "Team", "hours": "h"}


def report(spark, days, seed=1, rows=200):
    made = spark.range(rows * len(days)).select(
        F.concat(F.lit("user"), (F.xxhash64("id", F.lit(seed)) % 97).cast("string")).alias("Login"),
        F.date_add(F.lit(FIRST).cast("date"), F.element_at(F.lit(days), (F.col("id") % len(days) + 1).cast("int"))).alias("Data"),
        F.when(F.col("id") % 9 > 0, F.concat(F.lit("Żółw "), (F.col("id") % 31).cast("string"))).alias("Imię i Nazwisko"),
        F.element_at(F.array(*map(F.lit, ["A", "a", "B b", ""])), (F.xxhash64("id") % 2 + 2).cast("int")).alias("Team"),
        (F.col("id") % 5).cast("int").alias("h"),
    )
    rare = spark.createDataFrame([("needle Łoś", "2024-01-03", "Only one", "B b", 7)], "Login string, d string, n string, t string, h int")
    rare = rare.select("Login", F.col("d").cast("date"), "n", "t", "h")
    return made.union(rare) if 2 in days else made


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "r")
    write_days(report(spark, [0, 1, 2, 3, 8]), path)
    found = StoredReport(spark, path, LABELS)
    found.index(dense=50)
    return found


def rows(df):
    return sorted(map(str, df.collect()))


def test_facet_values(stored):
    for period in ((FIRST, LAST), ("2024-01-02", "2024-01-03"), ("2025-01-01", "2025-01-02")):
        scanned = facet_values(stored.rows(*period))
        found = stored.facet_values(*period)
        assert rows(found.drop("found")) == rows(scanned)
    counts = {(r["column_name"], r["value"]): r["found"] for r in stored.facet_values(FIRST, LAST).collect()}
    assert counts["team", "B b"] == stored.rows(FIRST, LAST).filter("team = 'B b'").count()


@pytest.mark.parametrize(
    "choices",
    [{"team": "a"}, {"team": "B B", "hours": "3"}, {"login": "USER5", "team": "A"}, {"name": "", "hours": "1"},
     {"login": "needle łoś"}, {"login": "nobody"}, {"hours": "7", "login": "needle łoś", "day": "2024-01-03"}, {}],
)
def test_filters_and_counts(stored, choices):
    scanned = facet_filter(stored.rows(FIRST, LAST), choices)
    assert rows(stored.filter(choices, FIRST, LAST)) == rows(scanned)
    counted = stored.count(choices, FIRST, LAST)
    assert counted.first()["found"] == scanned.count()
    assert not any("_index" not in file for file in counted.inputFiles())


def test_a_rare_choice_reads_its_file(stored):
    assert len(stored.filter({"login": "needle łoś"}, FIRST, LAST).inputFiles()) == 1


@pytest.mark.parametrize(
    "text", ["needle", "ŁOŚ", "user5 b", '"żółw 7"', '"Only one"  b', "x", "", "zzz", "er1 żó", '"b  2"', "❌ nothing"]
)
def test_search(stored, text):
    assert rows(stored.search(text, FIRST, LAST)) == rows(table_search(stored.rows(FIRST, LAST), text))


def test_a_rare_word_reads_its_file(spark, tmp_path):
    path = str(tmp_path / "r")
    write_days(report(spark, [0, 1, 2]).repartition(6, "Data"), path)
    # more files of the day that holds the word
    found = StoredReport(spark, path, LABELS)
    found.index()
    assert len(found.rows(FIRST, LAST).inputFiles()) == 3
    (file,) = found.search("needle", FIRST, LAST).inputFiles()
    assert "2024-01-03" in file
    assert found.search("needle", "2024-01-01", "2024-01-02").inputFiles() == []


def test_a_rewritten_day_gets_an_index_of_its_own(spark, tmp_path):
    path = str(tmp_path / "r")
    write_days(report(spark, [0, 1, 2]), path)
    found = StoredReport(spark, path, LABELS)
    with pytest.raises(LookupError):
        found.facet_values(FIRST, LAST)
    found.index()
    before = {folder: run for folder, run in found._indexed().items()}
    write_days(report(spark, [1], seed=2, rows=50), path)
    with pytest.raises(LookupError):
        found.search("user", FIRST, LAST)
    assert found.facet_values(FIRST, FIRST).count() > 0
    found.index()
    after = found._indexed()
    kept = [folder for folder in after if folder in before and "2024-01-02" not in folder]
    assert len(kept) == 2 and all(before[folder] == after[folder] for folder in kept)
    assert rows(found.facet_values(FIRST, LAST).drop("found")) == rows(facet_values(found.rows(FIRST, LAST)))
    assert found.count({"team": "a"}, FIRST, LAST).first()[0] == facet_filter(found.rows(FIRST, LAST), {"team": "a"}).count()
    # an index none of whose days is live goes
    write_days(report(spark, [0, 1, 2], seed=3, rows=20), path)
    found.index()
    assert len({run for run, _ in found._indexed().values()}) == 1


def test_days_are_stored_apart(stored):
    day = date.fromisoformat(FIRST) + timedelta(days=8)
    assert {row["day"] for row in stored.filter({"day": str(day)}, FIRST, LAST).collect()} == {day}


def test_an_empty_report(spark, tmp_path):
    path = str(tmp_path / "r")
    write_days(report(spark, [0]).limit(0), path)
    found = StoredReport(spark, path, LABELS)
    found.index()
    assert found.facet_values(FIRST, LAST).count() == 0
    assert found.count({"team": "a"}, FIRST, LAST).first()[0] == 0
    assert found.search("user", FIRST, LAST).count() == 0

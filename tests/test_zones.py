"""Offsets against the zone data of Python, around every kind of change."""

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from shiftledger import Rules
from shiftledger.functions.clock import duration_hours, duration_text
from shiftledger.functions.zones import Zone, offset_at, to_instant
from shiftledger.operators.activity import event_intervals
from tests.build import event, make_tables

#: Shifts of an hour, of half an hour, of a whole day, none, one in winter, and changes of the rule itself.
ZONES = ["Europe/Warsaw", "Australia/Lord_Howe", "Pacific/Apia", "UTC", "Europe/Dublin", "Asia/Pyongyang", "+05:30"]
MOMENTS = ["2024-03-31 02:30", "2024-10-27 02:30", "2024-04-07 01:45", "2024-10-06 02:15", "2011-12-30 12:00", "2015-08-14 23:45", "2018-05-04 23:40"]


def clock_times():
    out = [datetime(1960, 1, 1, 0, 0), datetime(2060, 7, 1, 12, 0, 0, 250_000)]
    for text in MOMENTS:
        at = datetime.fromisoformat(text)
        out += [at + timedelta(minutes=m, microseconds=u) for m in range(-150, 151, 15) for u in (0, 999_999)]
    return out


def python_instant(at, name, fold):
    zone = timezone(timedelta(hours=5, minutes=30)) if name == "+05:30" else ZoneInfo(name)
    # a time that is skipped has the offset before the change with fold 0
    first, second = (at.replace(tzinfo=zone, fold=f) for f in (0, 1))
    skipped = first.utcoffset() < second.utcoffset()
    chosen = first if skipped or fold == 0 else second
    return chosen.astimezone(timezone.utc).replace(tzinfo=None)


@pytest.mark.parametrize("name", ZONES)
@pytest.mark.parametrize("repeated", ["first", "second"])
def test_instants(spark, name, repeated):
    times = clock_times()
    df = spark.createDataFrame([(t,) for t in [*times, None]], "t timestamp_ntz")
    rows = df.select("t", to_instant(F.col("t"), Zone(name, repeated)).alias("utc")).collect()
    assert len(rows) == len(times) + 1
    for at, utc in rows:
        assert utc == (None if at is None else python_instant(at, name, int(repeated == "second"))), at


def hours(spark, zone, start, stop):
    df = spark.createDataFrame([(datetime.fromisoformat(start), datetime.fromisoformat(stop))], "a timestamp_ntz, b timestamp_ntz")
    row = df.select(duration_hours(F.col("a"), F.col("b"), zone), duration_text(F.col("a"), F.col("b"), zone)).first()
    return row[0], row[1]


def test_both_passes_of_a_repeated_hour(spark):
    night = ("2024-10-27 01:00", "2024-10-27 02:30")
    assert hours(spark, Zone("Europe/Warsaw", "first"), *night) == (1.5, "1:30")
    assert hours(spark, Zone("Europe/Warsaw", "second"), *night) == (2.5, "2:30")
    assert hours(spark, "Europe/Warsaw", *night) == (2.5, "2:30")


def test_half_an_hour_at_lord_howe(spark):
    """At 2:00 on 7 April 2024 the clock goes back to 1:30; on 6 October it goes from 2:00 to 2:30."""
    back, ahead = ("2024-04-07 01:00", "2024-04-07 01:45"), ("2024-10-06 01:00", "2024-10-06 03:00")
    assert hours(spark, Zone("Australia/Lord_Howe", "first"), *back) == (0.75, "0:45")
    assert hours(spark, Zone("Australia/Lord_Howe", "second"), *back) == (1.25, "1:15")
    assert hours(spark, "Australia/Lord_Howe", "2024-04-07 01:00", "2024-04-07 02:00") == (1.5, "1:30")
    assert hours(spark, "Australia/Lord_Howe", *ahead) == (1.5, "1:30")


def test_a_report_takes_the_pass(spark):
    events = [event(1, 1, 1, "2024-10-27 01:00"), event(1, 2, 2, "2024-10-27 02:30")]
    tables = make_tables(spark, events=events)
    day = ("2024-10-27", "2024-10-27", "2024-10-27 12:00:00")
    found = {}
    for repeated in ("first", "second"):
        rules = Rules(zone=Zone("Europe/Warsaw", repeated))
        found[repeated] = event_intervals(tables.clock_events, *day, rules).filter("event_id = 1").first()["hours"]
    assert found == {"first": 1.5, "second": 2.5}


def test_offsets_and_unknown_passes(spark):
    row = spark.range(1).select(offset_at(F.lit("2024-07-01").cast("timestamp_ntz"), "Europe/Warsaw")).first()
    assert row[0] == 7200
    with pytest.raises(ValueError):
        Zone("UTC", "third")

"""Reports and operators against the row-by-row rules on random tables."""

import random
from datetime import date, datetime, timedelta

import pytest

from shiftledger import detail_report, summary_report
from shiftledger.operators.successors import next_event
from shiftledger.plans.reports import employee_day_rows
from tests import model
from tests.build import make_tables, person

AS_OF = datetime(2024, 1, 9, 12, 34, 56)
DAYS = [date(2024, 1, 5), date(2024, 1, 6), date(2024, 1, 7)]
SPLITS = {
    "window": {"split_hot": False},
    "checked": {"split_hot": True},
    "all hot": {"split_hot": True, "hot_rows": 0},
    "some hot": {"split_hot": True, "hot_rows": 25},
}


def moment(rng, coarse):
    """Coarse moments collide; fine ones use microseconds."""
    day = datetime.combine(rng.choice(DAYS), datetime.min.time())
    if coarse:
        return day + timedelta(minutes=rng.choice([300, 301, 360, 600, 1379, 1439]))
    return day + timedelta(microseconds=rng.randrange(86_400_000_000))


def random_tables(seed):
    rng = random.Random(seed)
    people = [
        person(
            e,
            rng.choice([None, "x", "y", f"l{e}", f"l{e}"]),
            rng.choice(["A", "B"]),
            rng.choice(["C", None]),
            rng.choice([1, 2]),
        )
        for e in range(8)
    ]
    attributes = [
        (e, rng.choice(["B1", None]), "D", "F", rng.choice(["HC", "AGENCY"]), "P")
        for e in range(0, 10, 2)
    ]
    # employees 8 and up are unknown; employee 0 holds a third of the events
    ids = [None, 0, 0, 0, 0, 0, *range(1, 11)]
    works = []
    for _ in range(60):
        start = moment(rng, rng.random() < 0.5)
        stop = rng.choice([None, *[start + timedelta(minutes=rng.randrange(900))] * 4])
        works.append((rng.choice(ids), start, stop, 1.0, 50.0, rng.randrange(8)))
    events = [
        (n, moment(rng, rng.random() < 0.4), rng.choice([1, 2, 3, 4, 5, None]), rng.choice(ids))
        for n in range(220)
    ]
    events += [rng.choice(events) for _ in range(60)]  # delivered again
    hot = rng.choice(events)
    events += [hot] * 80  # one event delivered over and over
    # the same event id under another type
    events += [(e[0], e[1], 3, e[3]) for e in rng.sample(events, 10)]
    rng.shuffle(events)
    return works, events, people, attributes


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("split", SPLITS)
def test_next_event(spark, split):
    for seed in (1, 2):
        _, events, _, _ = random_tables(seed)
        tables = make_tables(spark, events=events)
        found = next_event(tables.clock_events, **SPLITS[split]).select(
            "employee_id", "event_ts", "event_id", "event_type", "next_ts"
        )
        assert rows_of(found) == sorted(model.next_events(events), key=str)


@pytest.mark.parametrize("seed", [3, 4])
def test_reports(spark, seed):
    works, events, people, attributes = random_tables(seed)
    tables = make_tables(spark, works, events, people, attributes)
    activity = model.activity(works, events, set(DAYS), AS_OF)
    details = []
    for employee, day, start, stop, kind, _ in activity:
        login, name, *extra, shift = model.attributes_of(employee, people, attributes)
        times = (model.hm(start), model.hm(stop), stop and model.span_text(start, stop))
        details.append((day, name, login, *extra, shift, *times, kind))
    summaries = model.summary(activity, people, attributes)

    period = (DAYS[0], DAYS[-1], AS_OF)
    for split in SPLITS.values():
        assert rows_of(detail_report(tables, *period, **split)) == sorted(details, key=str)
    for small_roster in (True, False):
        report = summary_report(tables, *period, small_roster=small_roster)
        assert rows_of(report) == sorted(summaries, key=str)
    members = employee_day_rows(tables, DAYS[0], DAYS[-1])
    assert rows_of(members) == sorted([row[:9] for row in summaries], key=str)


def test_days_are_independent(spark):
    works, events, people, attributes = random_tables(5)
    tables = make_tables(spark, works, events, people, attributes)
    for report in (detail_report, summary_report):
        whole = rows_of(report(tables, DAYS[0], DAYS[-1], AS_OF))
        daily = [row for day in DAYS for row in rows_of(report(tables, day, day, AS_OF))]
        assert whole == sorted(daily, key=str)


def test_input_order_does_not_matter(spark):
    works, events, people, attributes = random_tables(6)
    period = (DAYS[0], DAYS[-1], AS_OF)
    tables = make_tables(spark, works, events, people, attributes)
    backwards = make_tables(
        spark, works[::-1], events[::-1], people[::-1], attributes[::-1]
    )
    assert rows_of(summary_report(tables, *period)) == rows_of(summary_report(backwards, *period))


def test_session_zone_does_not_matter(spark):
    # 2024-03-31 02:30 does not exist in Warsaw
    night = "2024-03-31"
    events = [
        (1, datetime(2024, 3, 31, 1, 15), 1, 0),
        (2, datetime(2024, 3, 31, 2, 30), 3, 0),
        (3, datetime(2024, 3, 31, 4, 0), 4, 0),
    ]
    works = [(0, datetime(2024, 3, 31, 2, 30), datetime(2024, 3, 31, 11, 0), 1.0, 100.0, 2)]
    results = []
    try:
        for zone in ("UTC", "Europe/Warsaw"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            tables = make_tables(spark, works, events, [person(0, "a")])
            period = (night, night, f"{night} 12:00:00")
            detail, summary = detail_report(tables, *period), summary_report(tables, *period)
            results.append((rows_of(detail), rows_of(summary)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert results[0] == results[1]

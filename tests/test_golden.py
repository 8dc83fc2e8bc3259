"""One case per rule and boundary of the reports."""

import pytest
from pyspark.sql import functions as F

from shiftledger import Rules, detail_report, summary_report
from shiftledger.operators.activity import event_intervals
from shiftledger.operators.work_days import work_days
from tests.build import DAY, event, make_tables, person, ts, work

AS_OF = f"{DAY} 13:00:00"


def break_pair(employee, first_id):
    return [event(employee, first_id, 3, "10:00"), event(employee, first_id + 1, 4, "10:15")]


SUMMARY_CASES = {
    # login: (works, events), one employee each
    "g01": (lambda e: [work(e, "05:30", "14:00")], lambda e: break_pair(e, e * 10)),
    "g02": (lambda e: [work(e, "06:00:59", "14:00")], lambda e: break_pair(e, e * 10)),
    "g03": (lambda e: [work(e, "06:01", "14:01")], lambda e: break_pair(e, e * 10)),
    "g04": (lambda e: [work(e, "05:30", "13:29")], lambda e: break_pair(e, e * 10)),
    "g05": (lambda e: [work(e, "05:30", "14:00")], lambda e: []),
    "g06": (lambda e: [work(e, "22:00", "2024-01-06 06:00")], lambda e: []),
    "g11": (
        lambda e: [work(e, "05:30", "14:00")],
        lambda e: [event(e, e * 10, 3, "10:00:00"), event(e, e * 10 + 1, 4, "10:00:30")],
    ),
    "g12": (
        lambda e: [work(e, "05:30", "14:00")],
        lambda e: [
            event(e, e * 10 + 5, 3, "12:00"),
            event(e, e * 10 + 6, 4, "12:30"),
            event(e, e * 10 + 1, 3, "10:00"),
            event(e, e * 10 + 2, 4, "10:15"),
        ],
    ),
    "g13": (lambda e: [work(e, "05:30", None)], lambda e: []),
    "g20": (lambda e: [work(e, "08:00", "08:00")], lambda e: []),
}
SHORT, NO = "Poniżej 8h", "brak przerwy"
EXPECTED = {
    "g01": ("05:30", "14:00", "08:30", "0:15", "OK", "OK", "OK", "OK", "✔️"),
    "g02": ("06:00", "14:00", "08:00", "0:15", "OK", "OK", "OK", "OK", "✔️"),
    "g03": ("06:01", "14:01", "08:00", "0:15", "06:01", "OK", "OK", "OK", "❌"),
    "g04": ("05:30", "13:29", "07:59", "0:15", "OK", "13:29", SHORT, "OK", "❌"),
    "g05": ("05:30", "14:00", "08:30", None, "OK", "OK", "OK", NO, "❌"),
    "g06": ("22:00", "06:00", "08:00", None, "22:00", "OK", "OK", NO, "❌"),
    "g11": ("05:30", "14:00", "08:30", "0:0", "OK", "OK", "OK", "OK", "✔️"),
    "g12": ("05:30", "14:00", "08:30", "0:15", "OK", "OK", "OK", "OK", "✔️"),
    "g13": ("05:30", None, None, None, "OK", None, None, NO, "❌"),
    "g14": ("05:30", "15:00", "09:30", None, "OK", "OK", "OK", NO, "❌"),
    "g20": ("08:00", "08:00", "00:00", None, "08:00", "08:00", SHORT, NO, "❌"),
}
FACTS = [
    "start_hm",
    "stop_hm",
    "worked_hm",
    "break_hm",
    "start_check",
    "end_check",
    "hours_check",
    "break_check",
    "verdict",
]


def summary_case_tables(spark):
    works, events, people = [], [], []
    for number, (login, (make_works, make_events)) in enumerate(SUMMARY_CASES.items(), 1):
        works += make_works(number)
        events += make_events(number)
        people.append(person(number, login))
    # g14: two employees without master data
    works += [work(98, "05:30", "14:00"), work(99, "06:30", "15:00")]
    return make_tables(spark, works, events, people)


@pytest.mark.parametrize("small_roster", [True, False])
@pytest.mark.parametrize("split", [{}, {"split_hot": True, "hot_rows": 0}])
def test_summary_cases(spark, small_roster, split):
    report = summary_report(
        summary_case_tables(spark), DAY, DAY, AS_OF, small_roster=small_roster, **split
    )
    rows = report.collect()
    assert len(rows) == len(EXPECTED)
    found = {row["login"] or "g14": tuple(row[name] for name in FACTS) for row in rows}
    assert found == EXPECTED
    assert {row["comment"] for row in rows} == {None}


def test_shared_login_shares_facts(spark):
    tables = make_tables(
        spark,
        [work(1, "05:30", "10:00"), work(2, "09:00", "14:00")],
        [],
        [person(1, "a"), person(2, "a", "B", "B")],
    )
    for small_roster in (True, False):
        rows = summary_report(tables, DAY, DAY, AS_OF, small_roster=small_roster).collect()
        found = sorted((r["full_name"], r["start_hm"], r["stop_hm"], r["worked_hm"]) for r in rows)
        assert found == [("A A", "05:30", "14:00", "08:30"), ("B B", "05:30", "14:00", "08:30")]


def test_known_employees_without_login_share_facts(spark):
    tables = make_tables(
        spark,
        [work(1, "05:30", "10:00"), work(2, "09:00", "14:00")],
        [],
        [person(1, None), person(2, None, "B", "B")],
    )
    for small_roster in (True, False):
        rows = summary_report(tables, DAY, DAY, AS_OF, small_roster=small_roster).collect()
        assert sorted((r["full_name"], r["worked_hm"]) for r in rows) == [
            ("A A", "08:30"),
            ("B B", "08:30"),
        ]


def detail_rows(spark, works=(), events=(), as_of=AS_OF, rules=Rules(), to_day=DAY):
    tables = make_tables(spark, works, events, [person(1, "a")])
    report = detail_report(tables, DAY, to_day, as_of, rules)
    return sorted(
        (r["start_hm"], r["stop_hm"], r["duration_hm"], r["action"] or 0)
        for r in report.collect()
    )


def test_detail_of_a_full_day(spark):
    assert detail_rows(spark, [work(1, "05:30", "14:00")], break_pair(1, 1)) == [
        ("05:30", "14:00", "8:30", 0),
        ("10:00", "10:15", "0:15", 3),
        ("10:15", "13:00", "2:45", 4),
    ]


def test_flag_bit(spark):
    works = [work(1, "05:00", "06:00", flags=flags) for flags in (0, 1, 4, 5)]
    works += [work(1, "07:00", "08:00", flags=flags) for flags in (2, 3, 6, 7)]
    assert detail_rows(spark, works) == [("07:00", "08:00", "1:0", 0)]


def test_unlisted_type_only_ends_an_interval(spark):
    events = [event(1, 1, 1, "08:00"), event(1, 2, 5, "09:00"), event(1, 3, 2, "10:00")]
    assert detail_rows(spark, events=events, as_of=f"{DAY} 11:00:00") == [
        ("08:00", "09:00", "1:0", 1),
        ("10:00", "11:00", "1:0", 2),
    ]


def test_events_after_the_cutoff_do_not_exist(spark):
    events = [
        event(1, 1, 1, "22:59:59"),
        event(1, 2, 2, "22:59:59.500000"),
        event(1, 3, 2, "23:30"),
    ]
    assert detail_rows(spark, events=events, as_of=f"{DAY} 23:45:00") == [
        ("22:59", "23:45", "0:45", 1)
    ]
    late = detail_rows(
        spark, events=events, as_of=f"{DAY} 23:45:00", rules=Rules(event_cutoff="23:59:59")
    )
    assert late == [
        ("22:59", "22:59", "0:0", 1),
        ("22:59", "23:30", "0:30", 2),
        ("23:30", "23:45", "0:15", 2),
    ]


def test_duration_drops_whole_days(spark):
    events = [event(1, 1, 1, "08:00")]
    assert detail_rows(spark, events=events, as_of="2024-01-09 12:05:00") == [
        ("08:00", "12:05", "4:5", 1)
    ]


def test_report_time_before_the_event_gives_a_negative_duration(spark):
    events = [event(1, 1, 1, "08:00")]
    assert detail_rows(spark, events=events, as_of=f"{DAY} 06:30:00") == [
        ("08:00", "06:30", "-1:-30", 1)
    ]


@pytest.mark.parametrize("split", [{}, {"split_hot": True, "hot_rows": 0}])
def test_repeated_delivery(spark, split):
    events = [event(1, 1, 1, "06:00")] * 3 + [event(1, 2, 2, "09:00")]
    tables = make_tables(spark, [], events, [person(1, "a")])
    rows = detail_report(tables, DAY, DAY, f"{DAY} 10:00:00", **split).collect()
    assert sorted((r["start_hm"], r["stop_hm"], r["duration_hm"], r["action"]) for r in rows) == [
        ("06:00", "06:00", "0:0", 1),
        ("06:00", "09:00", "3:0", 1),
        ("09:00", "10:00", "1:0", 2),
    ]


@pytest.mark.parametrize("split", [{}, {"split_hot": True, "hot_rows": 0}])
def test_repeated_delivery_that_ends_at_the_report_time(spark, split):
    events = [event(1, 1, 1, "06:00")] * 3
    tables = make_tables(spark, [], events, [person(1, "a")])
    rows = detail_report(tables, DAY, DAY, f"{DAY} 06:00:00", **split).collect()
    assert [(r["start_hm"], r["stop_hm"]) for r in rows] == [("06:00", "06:00")]


def test_name_is_null_if_a_part_is(spark):
    tables = make_tables(spark, [work(1, "05:30", "14:00")], [], [person(1, "a", "A", None)])
    assert [r["full_name"] for r in detail_report(tables, DAY, DAY, AS_OF).collect()] == [None]


def test_event_hours_and_search_key(spark):
    events = [
        event(1, 1, 1, "06:00"),
        event(1, 2, 2, "08:30"),
        event(1, 3, 3, "09:00"),
        event(1, 4, 4, "09:30"),
    ]
    tables = make_tables(spark, [], events)
    rows = event_intervals(tables.clock_events, DAY, DAY, f"{DAY} 10:00:00").collect()
    by_id = {row["event_id"]: row for row in rows}
    assert [by_id[i]["hours"] for i in (1, 2, 3, 4)] == [2.5, 0.0, 0.5, 0.0]
    assert {row["effective_hours"] for row in rows} == {0.0}
    assert by_id[1]["search_key"] == "12024-01-051"
    assert {row["source"] for row in rows} == {1}


def test_work_days(spark):
    works = [
        work(1, "05:00", "07:00", 2.0, 50.0),
        work(1, "09:00", "13:00", 4.0, 100.0),
        work(1, "2024-01-06 05:00", "2024-01-06 07:00", 2.0, 100.0),
    ]
    tables = make_tables(spark, works)
    (row,) = work_days(tables.work_records, DAY, DAY).collect()
    assert (row["hours"], row["effective_hours"]) == (6.0, 5.0)
    assert (row["start_ts"], row["stop_ts"]) == (ts("05:00"), ts("13:00"))


def test_repeated_dimension_keys_repeat_detail_rows_only(spark):
    tables = make_tables(
        spark,
        [work(1, "05:30", "14:00")],
        [],
        [person(1, "a")],
        departments=[(1,), (1,)],
        positions=[(1,), (1,), (1,)],
    )
    assert detail_report(tables, DAY, DAY, AS_OF).count() == 6
    unique = Rules(assume_unique_dimensions=True)
    assert detail_report(tables, DAY, DAY, AS_OF, unique).count() == 1
    assert summary_report(tables, DAY, DAY, AS_OF).count() == 1


def test_attributes_hang_on_the_employee_found(spark):
    attributes = [(1, "B1", "X", "F", "HC", "P"), (2, "B2", "Y", "F", "HC", "P")]
    tables = make_tables(
        spark,
        [work(1, "05:30", "14:00"), work(2, "05:30", "14:00"), work(None, "05:30", "14:00")],
        [],
        [person(1, "a")],
        attributes,
    )
    rows = detail_report(tables, DAY, DAY, AS_OF).select("login", "bibi").collect()
    assert sorted(map(tuple, rows), key=str) == [("a", "B1"), (None, None), (None, None)]


def test_absolute_time_over_a_clock_change(spark):
    night = "2024-03-31"
    events = [(1, ts(f"{night} 00:00"), 1, 1), (2, ts(f"{night} 06:00"), 2, 1)]
    tables = make_tables(spark, [], events, [person(1, "a")])
    as_of = f"{night} 07:00:00"
    durations = {}
    for zone in (None, "Europe/Warsaw"):
        rules = Rules(zone=zone)
        rows = detail_report(tables, night, night, as_of, rules).filter(F.col("action") == 1)
        durations[zone] = rows.first()["duration_hm"]
        hours = event_intervals(tables.clock_events, night, night, as_of, rules)
        durations[zone, "hours"] = hours.filter("event_id = 1").first()["hours"]
    assert durations == {
        None: "6:0",
        (None, "hours"): 6.0,
        "Europe/Warsaw": "5:0",
        ("Europe/Warsaw", "hours"): 5.0,
    }


def test_a_repeated_hour_is_read_as_standard_time(spark):
    night = "2024-10-27"
    events = [(1, ts(f"{night} 00:00"), 1, 1), (2, ts(f"{night} 02:30"), 2, 1)]
    tables = make_tables(spark, [], events, [person(1, "a")])
    rows = detail_report(
        tables, night, night, f"{night} 07:00:00", Rules(zone="Europe/Warsaw")
    ).collect()
    assert {r["action"]: r["duration_hm"] for r in rows} == {1: "3:30", 2: "4:30"}


@pytest.mark.parametrize("small_roster", [True, False])
def test_employee_with_several_master_rows(spark, small_roster):
    people = [person(1, "a"), person(1, "a", "C", "C"), person(1, "b"), person(2, "b")]
    attributes = [(1, bibi, "X", "F", "HC", "P") for bibi in ("B1", "B2")]
    works = [work(1, "05:30", "14:00"), work(2, "07:00", "16:00")]
    tables = make_tables(spark, works, [], people, attributes)
    rows = summary_report(tables, DAY, DAY, AS_OF, small_roster=small_roster).collect()
    found = sorted(
        (r["login"], r["full_name"], r["bibi"] or "", r["start_hm"], r["stop_hm"]) for r in rows
    )
    assert found == [
        ("a", "A A", "B1", "05:30", "14:00"),
        ("a", "A A", "B2", "05:30", "14:00"),
        ("a", "C C", "B1", "05:30", "14:00"),
        ("a", "C C", "B2", "05:30", "14:00"),
        ("b", "A A", "", "05:30", "16:00"),
        ("b", "A A", "B1", "05:30", "16:00"),
        ("b", "A A", "B2", "05:30", "16:00"),
    ]
    assert detail_report(tables, DAY, DAY, AS_OF).count() == 7


def test_event_hours_are_rounded_once(spark):
    """Through seconds as a double, this one would come out as 1.8127624999999998."""
    events = [event(1, 1, 1, "06:00"), event(1, 2, 2, "07:48:45.945")]
    tables = make_tables(spark, [], events)
    rows = event_intervals(tables.clock_events, DAY, DAY, f"{DAY} 10:00:00").collect()
    assert {row["event_id"]: row["hours"] for row in rows}[1] == 1.8127625

"""The report rules restated row by row, as a check on the set-based form."""

from __future__ import annotations

from collections import defaultdict
from datetime import datetime, time, timedelta
from itertools import groupby


def hm(moment):
    return moment.strftime("%H:%M") if moment else None


def span_text(start, stop):
    micros = (stop - start) // timedelta(microseconds=1)
    sign = -1 if micros < 0 else 1
    minutes = abs(micros) // 60_000_000 % 1440
    return f"{sign * (minutes // 60)}:{sign * (minutes % 60)}"


def low(value):
    """Sort key with null first."""
    return (value is not None, value if value is not None else 0)


def next_events(events):
    """Distinct (employee, ts, id, type, next), events given as table rows."""
    found = set()
    dated = sorted(events, key=lambda e: (low(e[3]), e[1], e[0], low(e[2])))
    for _, group in groupby(dated, key=lambda e: (e[3], e[1].date())):
        chain = list(group)
        for here, after in zip(chain, [*chain[1:], None]):
            found.add((here[3], here[1], here[0], here[2], after and after[1]))
    return found


def activity(works, events, days, as_of, cutoff=time(22, 59, 59)):
    """Rows (employee, day, start, stop, type, event id)."""
    spans = defaultdict(list)
    for employee, start, stop, _, _, flags in works:
        if start.date() in days and flags & 2:
            spans[employee, start.date()].append((start, stop))
    rows = []
    for (employee, day), pairs in spans.items():
        stops = [stop for _, stop in pairs if stop]
        rows.append(
            (employee, day, min(s for s, _ in pairs), max(stops, default=None), None, None)
        )
    on_time = [e for e in events if e[1].date() in days and e[1].time() <= cutoff]
    intervals = {
        (employee, at.date(), at, after or as_of, kind, event_id)
        for employee, at, event_id, kind, after in next_events(on_time)
        if kind in (1, 2, 3, 4)
    }
    return rows + list(intervals)


def attributes_of(employee, people, attributes):
    for e, login, first, last, shift, _, _ in people:
        if e == employee:
            name = f"{first} {last}" if first and last else None
            extra = next((a[1:] for a in attributes if a[0] == employee), (None,) * 5)
            return (login, name, *extra, shift)
    return (None,) * 8


def summary(rows, people, attributes):
    by_login = defaultdict(list)
    members = set()
    for row in rows:
        login, *rest = attributes_of(row[0], people, attributes)
        by_login[login, row[1]].append(row)
        members.add((login, row[1], *rest))
    result = []
    for member in members:
        shared = by_login[member[0], member[1]]
        start = min(hm(r[2]) for r in shared)
        stop = max((hm(r[3]) for r in shared if r[3]), default=None)
        breaks = sorted((r[2], r[5], r[3]) for r in shared if r[4] == 3)
        pause = span_text(breaks[0][0], breaks[0][2]) if breaks else None
        worked = None
        if stop is not None:
            difference = datetime.strptime(stop, "%H:%M") - datetime.strptime(start, "%H:%M")
            worked = difference // timedelta(minutes=1) % 1440
        checks = (
            "OK" if start <= "06:00" else start,
            None if worked is None else "OK" if worked >= 480 else stop,
            None if worked is None else "OK" if worked >= 480 else "Poniżej 8h",
            "OK" if pause else "brak przerwy",
        )
        text = None if worked is None else f"{worked // 60:02}:{worked % 60:02}"
        grade = "✔️" if set(checks) == {"OK"} else "❌"
        result.append((*member, start, stop, text, pause, None, *checks, grade))
    return result

"""The next event of the same employee on the same day.

``next_event`` is a ``lead`` over (employee, day, slice) ordered by time, event
id and event type.  A window keeps one group in one task, which is wrong for an
employee-day that holds a large share of all events (a shared badge, an event
delivered over and over).  So the groups are counted first: events per hash
bucket of (employee, day), which reads two columns and yields at most
``BUCKETS`` rows; then, within buckets above ``HOT_ROWS``, per employee-day.

* No employee-day is above ``HOT_ROWS``: the window alone, one shuffle.
* Some are: the same count samples their distinct events by hash, and every so
  many of the sample in order bound a slice.  A slice holds about ``HOT_ROWS``
  events, and more only where that would make over ``SLICES`` of them: the
  bounds pass through the driver, and do not become more as events do.  Copies
  are collapsed before the shuffle, and each event finds its slice by a binary
  search of the bounds.  All events still share one shuffle and one window; the
  last event of a slice is followed by the first of the next, a small table of
  one row a slice.

The limit does not depend on the data, and both ways give the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftledger.functions.clock import calendar_day
from shiftledger.operators.joins import left_join_null_safe
from shiftledger.session import ensure_checkpoint_dir

BUCKETS = 65_536
#: Events of one employee-day that a window may hold.
HOT_ROWS = 1_000_000
#: Hot employee-days are broadcast up to this many, and joined by Spark's choice beyond.
BROADCAST_KEYS = 100_000
#: Slices of all hot employee-days together, about.
SLICES = 100_000
#: Events sampled for a slice of a hot employee-day.
SAMPLES = 32

_EVENT = ["employee_id", "day", "event_ts", "event_id", "event_type"]
_ORDER = _EVENT[2:]
_SLICE = ["employee_id", "day", "slice"]


def _bucket() -> Column:
    return F.pmod(F.xxhash64("employee_id", "day"), F.lit(BUCKETS)).cast("int")


@dataclass(frozen=True)
class HotDays:
    """Employee-days above the limit as a table with the bounds of their slices, or None if there are none."""

    keys: DataFrame | None
    #: The most bounds of an employee-day.
    bounds: int = 0


def _overfull(dated: DataFrame, hot_rows: int) -> tuple[list[int], int]:
    """Buckets above the limit and their rows; the driver gets one row with at most ``BUCKETS`` of them."""
    counts = dated.groupBy(_bucket().alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
    above = counts.filter(F.col("rows") > hot_rows)
    buckets, rows = above.agg(F.collect_list("bucket"), F.sum("rows")).first()
    return buckets, rows or 0


def hot_buckets(dated: DataFrame, hot_rows: int) -> list[int]:
    return _overfull(dated, hot_rows)[0]


def _bounds(slice_rows: int) -> Column:
    """Of the distinct events of a group, sampled by hash, the first of every slice but the first."""
    every = max(1, slice_rows // SAMPLES)
    step = SAMPLES if every > 1 else max(1, slice_rows)
    sampled = F.pmod(F.xxhash64(*_ORDER), F.lit(every)) == 0
    in_order = F.sort_array(F.collect_set(F.when(sampled, F.struct(*_ORDER))))
    return F.filter(in_order, lambda _, place: (place > 0) & (place % step == 0))


def hot_days(events: DataFrame, hot_rows: int = HOT_ROWS) -> HotDays:
    """Count, and find the employee-days above the limit.  Runs a job, and a second if a bucket is."""
    dated = events.withColumn("day", calendar_day(F.col("event_ts"))).select(*_EVENT)
    buckets, rows = _overfull(dated, hot_rows)
    if not buckets:
        return HotDays(None)
    slice_rows = max(hot_rows, -(-rows // SLICES))
    spark = events.sparkSession
    # an Arrow table becomes a local relation; a list would start Python workers
    overfull = spark.createDataFrame(pa.table({"bucket": pa.array(buckets, pa.int32())}))
    keys = (
        dated.withColumn("bucket", _bucket())
        .join(F.broadcast(overfull), "bucket", "left_semi")
        .groupBy("employee_id", "day")
        .agg(F.count(F.lit(1)).alias("rows"), _bounds(slice_rows).alias("bounds"))
        .filter(F.col("rows") > hot_rows)
        .select(F.col("employee_id").alias("hot_employee"), F.col("day").alias("hot_day"), "bounds")
    )
    found = keys.limit(BROADCAST_KEYS + 1).toArrow()
    if found.num_rows == 0:
        return HotDays(None)
    if found.num_rows <= BROADCAST_KEYS:
        most = pc.max(pc.list_value_length(found.column("bounds"))).as_py()
        return HotDays(F.broadcast(spark.createDataFrame(found)), most)
    ensure_checkpoint_dir(spark)
    keys = keys.checkpoint()
    return HotDays(keys, keys.agg(F.max(F.size("bounds"))).first()[0])


def _by_window(events: DataFrame, group: list[str]) -> DataFrame:
    in_order = Window.partitionBy(*group).orderBy(*_ORDER)
    same_as_previous = [F.lag(name).over(in_order).eqNullSafe(F.col(name)) for name in _ORDER]
    return events.select(
        *_EVENT,
        *[name for name in group if name not in _EVENT],
        F.lead("event_ts").over(in_order).alias("next_ts"),
        reduce(lambda a, b: a & b, same_as_previous).alias("is_copy"),
    )


def _slice_of(event: Column, bounds: Column, most: int) -> Column:
    """How many bounds, ``most`` of them at most, are not above the event; by binary search."""
    steps = [1 << bit for bit in reversed(range(most.bit_length()))]
    if not steps:
        return F.lit(0)

    def further(place: Column, step: Column) -> Column:
        # a step too far reads null, and stays
        return F.when(F.get(bounds, place + step - 1) <= event, place + step).otherwise(place)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), further)


def _same_day(hot: DataFrame) -> Column:
    return F.col("employee_id").eqNullSafe(hot["hot_employee"]) & F.col("day").eqNullSafe(
        hot["hot_day"]
    )


def _successors_by_slice(dated: DataFrame, days: HotDays) -> DataFrame:
    """As the window over (employee, day), with hot employee-days in slices."""
    hot = days.keys
    ordinary = dated.join(hot, _same_day(hot), "left_anti")
    distinct = dated.join(hot, _same_day(hot), "left_semi").groupBy(*_EVENT)
    # of equal events the first and the last, of which only the last is followed by another
    copies = distinct.agg(F.least(F.count(F.lit(1)), F.lit(2)).cast("int").alias("copies"))
    event = F.struct(*_ORDER)
    sliced = copies.join(hot, _same_day(hot)).withColumn(
        "slice", _slice_of(event, F.col("bounds"), days.bounds) + 1
    )
    repeated = sliced.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies"))))
    everything = ordinary.withColumn("slice", F.lit(0)).unionByName(repeated.select(*_EVENT, "slice"))
    followed = _by_window(everything, _SLICE)

    # with the copies, as branches that read the same columns share one shuffle
    first = sliced.groupBy(*_SLICE).agg(F.min(F.struct("event_ts", "copies")).alias("first"))
    along = Window.partitionBy("employee_id", "day").orderBy("slice")
    later = first.select(*_SLICE, F.lead("first.event_ts").over(along).alias("later_ts"))
    joined = left_join_null_safe(followed, later, _SLICE)
    return joined.select(*_EVENT, F.coalesce("next_ts", "later_ts").alias("next_ts"), "is_copy")


def successors(
    events: DataFrame,
    split_hot: bool = True,
    hot_rows: int = HOT_ROWS,
    hot: HotDays | None = None,
) -> DataFrame:
    """Events with ``day``, ``next_ts`` and ``is_copy``.

    ``next_ts`` is null for the last event of an employee-day.  ``is_copy``
    marks a row whose event equals the one before it in every column.  Copies
    between the first and the last may be left out; they repeat the first.
    ``split_hot`` says whether to count; ``hot`` hands over an earlier count.
    """
    dated = events.withColumn("day", calendar_day(F.col("event_ts"))).select(*_EVENT)
    if hot is None:
        hot = hot_days(events, hot_rows) if split_hot else HotDays(None)
    if hot.keys is None:
        return _by_window(dated, ["employee_id", "day"])
    return _successors_by_slice(dated, hot)


def drop_repeats(rows: DataFrame, start: str, stop: str) -> DataFrame:
    """Distinct rows of ``successors``, without a shuffle.

    Rows of one event differ only in their end, and all copies but the last end
    where they start.  So a copy is a duplicate exactly if it ends there too.
    """
    repeats = F.col("is_copy") & F.col(stop).eqNullSafe(F.col(start))
    return rows.filter(~repeats).drop("is_copy")


def next_event(events: DataFrame, **split) -> DataFrame:
    """Distinct events with the time of their successor."""
    return drop_repeats(successors(events, **split), "event_ts", "next_ts")

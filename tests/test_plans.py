"""Physical plans: shuffles, broadcasts and the handling of skew."""

import pytest
from pyspark.sql import functions as F

from catalog.queries import AS_OF, FROM_DAY, TO_DAY
from shiftledger import detail_report, summary_report
from shiftledger.operators.activity import activity, event_intervals
from shiftledger.operators.filters import in_event_window
from shiftledger.operators.successors import (
    BUCKETS, _same_day, _slice_of, hot_buckets, hot_days, next_event, successors,
)
from shiftledger.plans.reports import employee_day_rows
from shiftledger.sources.sample import SampleTables
from tests.build import event, make_tables, person, ts

PERIOD = (FROM_DAY, TO_DAY, AS_OF)


@pytest.fixture(scope="module")
def tables(spark):
    return SampleTables(spark, "/root/testdata/sf0.001")


def initial_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def conf(spark, settings):
    """Set, and return what to restore."""
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    return before


def test_intervals_take_one_shuffle(tables):
    events = in_event_window(tables.clock_events, FROM_DAY, TO_DAY, "22:59:59")
    plan = initial_plan(next_event(events))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Window [") == 1


def test_detail_shuffles_each_fact_table_once(tables):
    plan = initial_plan(detail_report(tables, *PERIOD))
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("BroadcastHashJoin") == 4
    assert "SortMergeJoin" not in plan


def test_summary_shuffles_narrow_rows(tables):
    plan = initial_plan(summary_report(tables, *PERIOD))
    # work days, events, person-days, login-days; none for the distinct
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 4
    # attributes are attached after the last shuffle
    first_shuffle = next(n for n, line in enumerate(plan.splitlines()) if line in exchanges)
    above = "\n".join(plan.splitlines()[:first_shuffle])
    assert above.count("BroadcastHashJoin") == 2
    # departments and positions add nothing to distinct rows
    assert plan.count("BroadcastHashJoin") == 3


def test_employee_days_need_no_window(tables):
    assert "Window" not in initial_plan(employee_day_rows(tables, FROM_DAY, TO_DAY))


def test_no_python_in_any_plan(tables):
    for report in (detail_report, summary_report):
        assert "Python" not in initial_plan(report(tables, *PERIOD))


def test_large_roster_reads_the_facts_once(tables):
    plan = final_plan(summary_report(tables, *PERIOD, small_roster=False))
    assert "ReusedExchange" in plan
    assert plan.count("FileScan parquet [l_orderkey") == 1
    assert plan.count("FileScan parquet [event_id") == 1


def test_roster_beyond_the_broadcast_threshold(spark, tables):
    before = conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"})
    try:
        for report in (detail_report, summary_report):
            found = report(tables, *PERIOD)
            assert "Broadcast" not in initial_plan(found)
            rows = sorted(map(str, found.collect()))
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
            assert rows == sorted(map(str, report(tables, *PERIOD).collect()))
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    finally:
        conf(spark, before)


def test_adaptive_execution_splits_a_hot_employee(spark):
    """A third of the events of one employee, and a roster too large to broadcast."""
    times = [f"{h:02}:{m:02}:{s:02}" for h in range(8, 20) for m in range(60) for s in (0, 30)]
    events = [event(1, n, 1, at) for n, at in enumerate(times)]
    events += [event(2 + n % 400, 10_000 + n, 1, at) for n, at in enumerate(times * 2)]
    people = [person(e, f"l{e}") for e in range(500)]
    tables = make_tables(spark, [], events, people)
    before = conf(
        spark,
        {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        },
    )
    try:
        split = {"split_hot": True, "hot_rows": 1000}
        report = detail_report(tables, "2024-01-05", "2024-01-05", ts("21:00"), **split)
        plan = final_plan(report)
        assert "skew=true" in plan
        assert report.count() == len(events)
    finally:
        conf(spark, before)


def test_hot_check(tables):
    events = in_event_window(tables.clock_events, FROM_DAY, TO_DAY, "22:59:59").selectExpr(
        "*", "cast(event_ts as date) as day"
    )
    counted = events.groupBy("employee_id", "day").count().collect()
    sizes = sorted(row["count"] for row in counted)
    assert hot_buckets(events, 1_000_000) == []
    assert hot_buckets(events.limit(0), 0) == []
    assert 0 < len(hot_buckets(events, 0)) <= min(BUCKETS, len(sizes))
    assert hot_days(events, sizes[-1]).keys is None
    # the limit is per employee-day, whatever else its bucket holds
    limit = sizes[len(sizes) // 2]
    assert hot_days(events, limit).keys.count() == sum(size > limit for size in sizes)


def test_the_limit_does_not_grow_with_the_events(spark):
    """More events than buckets times the limit, and one employee-day above it."""
    dated = "timestamp_ntz '2024-01-05 08:00:00' + make_dt_interval(0, 0, 0, cast(id % 40000 as decimal(18,6)))"
    events = spark.range(2 * BUCKETS + 100).selectExpr(
        "id as event_id", f"{dated} as event_ts", "1 as event_type",
        "case when id < 100 then 0 else id end as employee_id",
    )
    keys = hot_days(events, hot_rows=2).keys
    assert [row["hot_employee"] for row in keys.collect()] == [0]


def test_copies_in_a_small_file_are_counted(spark, tmp_path):
    one = "timestamp_ntz '2024-01-05 08:00:00' as event_ts, 1 as event_type, 1L as employee_id"
    spark.range(200_000).selectExpr("7L as event_id", *one.split(", ")).write.parquet(f"{tmp_path}/e")
    events = spark.read.parquet(f"{tmp_path}/e")
    found = successors(events, hot_rows=100_000)
    assert "Union" in initial_plan(found)
    assert next_event(events, hot_rows=100_000).count() == 2


def test_a_count_serves_both_reports(tables):
    events = in_event_window(tables.clock_events, FROM_DAY, TO_DAY, "22:59:59")
    hot = hot_days(events, 0)
    for report in (detail_report, summary_report):
        assert "LeftAnti" in initial_plan(report(tables, *PERIOD, hot=hot))


def test_both_reports_read_the_facts_once(tables):
    facts = activity(tables, *PERIOD).persist()
    try:
        for report in (detail_report, summary_report):
            plan = final_plan(report(tables, *PERIOD, facts=facts))
            # the only scans are those that filled the cache
            cached = plan[plan.index("InMemoryRelation") :]
            for table in ("event_id", "l_orderkey"):
                assert plan.count(f"FileScan parquet [{table}") == cached.count(f"FileScan parquet [{table}") == 1
    finally:
        facts.unpersist()


def test_departments_of_unknown_size_move_no_activity(spark, tables):
    class Unknown:
        """The tables, with departments that Spark has no size of."""

        count_events = True

        def __getattr__(self, name):
            df = getattr(tables, name)
            return spark.createDataFrame(df.rdd, df.schema) if name == "departments" else df

    plan = initial_plan(detail_report(Unknown(), *PERIOD))
    # the activity is shuffled by employee only; the department meets the master data
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(department_id" in line]
    assert len(moved) == 1
    assert plan.index("Exchange hashpartitioning(employee_id") < plan.index(moved[0])
    assert "Union" not in plan[plan.index(moved[0]) :]


def test_only_hot_events_are_split(tables):
    """Ordinary events keep the one-shuffle window beside the split."""
    events = in_event_window(tables.clock_events, FROM_DAY, TO_DAY, "22:59:59")
    plan = initial_plan(successors(events, split_hot=True, hot_rows=3))
    assert "LeftAnti" in plan and "LeftSemi" in plan
    assert "Union" in plan


def test_split_events_are_read_once(tables):
    events = in_event_window(tables.clock_events, FROM_DAY, TO_DAY, "22:59:59")
    split = {"split_hot": True, "hot_rows": 3}
    intervals = event_intervals(tables.clock_events, *PERIOD, **split)
    for df in (next_event(events, **split), intervals):
        plan = final_plan(df)
        # the ordinary events, the hot events; the buckets are a local relation
        assert plan.count("FileScan parquet") == 2
        assert "LocalTableScan" in plan and "ExistingRDD" not in plan
        assert plan.count("ReusedExchange") >= 2


def hot_events(spark, rows=60_000):
    """Two thirds in one employee-day: few instants with many events each, copies, and null ids and types."""
    moment = "timestamp_ntz '2024-01-05 08:00:00' + make_dt_interval(0, 0, 0, cast(pmod(hash(id), 500) as decimal(18,6)))"
    return spark.range(rows).selectExpr(
        "if(id % 7 = 0, null, if(id % 11 = 0, 5L, id)) as event_id",
        f"if(id % 11 = 0, timestamp_ntz '2024-01-05 09:00:00', {moment}) as event_ts",
        "if(id % 13 = 0, null, cast(id % 5 as int)) as event_type",
        "if(id % 3 < 2, 1L, if(id % 3 = 2 and id % 17 = 0, null, id % 400)) as employee_id",
    )


def test_a_hot_day_is_cut_into_even_slices(spark):
    events = hot_events(spark)
    found = hot_days(events, 1000)
    hot = found.keys
    dated = events.withColumn("day", F.col("event_ts").cast("date")).distinct()
    sizes = (
        dated.join(hot, _same_day(hot))
        .withColumn("slice", _slice_of(F.struct("event_ts", "event_id", "event_type"), F.col("bounds"), found.bounds))
        .groupBy("employee_id", "day", "slice")
        .count()
        .collect()
    )
    assert len(sizes) > 20
    assert max(row["count"] for row in sizes) < 2000


@pytest.mark.parametrize("hot_rows", [0, 1, 40, 1000])
def test_slices_give_the_rows_of_the_window(spark, hot_rows):
    events = hot_events(spark, 6_000)
    columns = ["employee_id", "day", "event_ts", "event_id", "event_type", "next_ts"]

    def rows(df):
        return sorted(map(str, df.select(*columns).collect()))

    plain = rows(next_event(events, split_hot=False))
    assert rows(next_event(events, hot_rows=hot_rows)) == plain
    assert len(plain) < 6_000


@pytest.mark.parametrize("hot_rows", [0, 40])
def test_bounds_do_not_grow_with_the_events(spark, monkeypatch, hot_rows):
    monkeypatch.setattr("shiftledger.operators.successors.SLICES", 20, raising=False)
    for rows in (6_000, 24_000):
        events = hot_events(spark, rows)
        found = hot_days(events, hot_rows)
        bounds = found.keys.agg(F.sum(F.size("bounds"))).first()[0]
        assert 4 < bounds < 40
        split = next_event(events, hot_rows=hot_rows)
        plain = next_event(events, split_hot=False).select(split.columns)
        assert split.exceptAll(plain).count() == plain.exceptAll(split).count() == 0


def test_slices_share_one_shuffle_and_one_window(tables):
    events = in_event_window(tables.clock_events, FROM_DAY, TO_DAY, "22:59:59")
    plan = initial_plan(successors(events, hot_rows=3))
    # the copies before it, the events themselves, and what orders the first of each slice
    whole = [line for line in plan.splitlines() if "Window [" in line and "event_ts" in line]
    assert len([line for line in whole if "next_ts" in line]) == 1
    assert plan.count("hashpartitioning(employee_id#") <= 6

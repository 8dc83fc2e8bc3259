"""Write both reports: ``spark-submit -m shiftledger`` or ``python -m shiftledger``."""

from __future__ import annotations

import argparse
from datetime import date, datetime

from pyspark.sql import SparkSession

from shiftledger.operators.activity import activity
from shiftledger.operators.labels import DETAIL_LABELS, SUMMARY_LABELS, labeled
from shiftledger.plans.reports import detail_report, summary_report
from shiftledger.sources.sinks import export_csv, read_report, write_days
from shiftledger.sources.tables import read_tables


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="shiftledger", description=__doc__)
    parser.add_argument("day", type=date.fromisoformat, help="first (or only) day, YYYY-MM-DD")
    parser.add_argument("--to", type=date.fromisoformat, help="last day, if more than one")
    parser.add_argument("--as-of", type=datetime.fromisoformat, help="end of open intervals")
    parser.add_argument("--tables", required=True, help="directory of the six input tables")
    parser.add_argument("--out", required=True, help="directory for the reports")
    parser.add_argument("--csv", action="store_true", help="also export the summary as one CSV file")
    parser.add_argument("--day-partition", help="partition column that equals the calendar day")
    parser.add_argument("--source-zone", help="zone whose wall clock instants are read as")
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("shiftledger").getOrCreate()
    tables = read_tables(
        spark, options.tables, day_partition=options.day_partition, source_zone=options.source_zone
    )
    days = (options.day, options.to or options.day)
    period = (*days, options.as_of or datetime.now())
    # both reports read the facts once; what an executor loses is computed again
    facts = activity(tables, *period).persist()
    detail = labeled(detail_report(tables, *period, facts=facts), DETAIL_LABELS)
    summary = labeled(summary_report(tables, *period, facts=facts), SUMMARY_LABELS)
    write_days(detail, f"{options.out}/detail", period=days)
    write_days(summary, f"{options.out}/summary", period=days)
    facts.unpersist()
    if options.csv:
        stored = read_report(spark, f"{options.out}/summary", SUMMARY_LABELS, *days)
        print(export_csv(labeled(stored, SUMMARY_LABELS), f"{options.out}/csv"))


if __name__ == "__main__":
    main()

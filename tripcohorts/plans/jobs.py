"""The two studies as batch jobs.

A job reads the trips once for all cuts: totals of every cut are computed together, kept in
the checkpoint folder, and each result is read off them. Results are written in their order,
one CSV part each, and what is shown is read back from there. Previews are cut after
PREVIEW_ROWS rows and say so; ``report --out`` writes whole report tables.
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from tripcohorts.config import DateStudy, MonthStudy
from tripcohorts.functions.cohorts import in_month_folders
from tripcohorts.operators.zones import repeated_zone_ids
from tripcohorts.plans import date_study, month_study, reports
from tripcohorts.session import build_session, cut_lineage, remove_checkpoints
from tripcohorts.sinks.monthly import write_monthly
from tripcohorts.sinks.results import write_single_csv
from tripcohorts.sources.catalog import register_tables, registered_tables
from tripcohorts.sources.results import read_result
from tripcohorts.sources.tables import read_trips, read_zones

PREVIEW_ROWS = 100


def run_date_study(
    trips: DataFrame, zones: DataFrame, out: str, study: DateStudy = DateStudy()
) -> dict[str, DataFrame]:
    """Writes six cuts to ``out`` and three quality tables to ``out/eda``.

    Two scans of the study rows, whatever the number of tables: one for all cuts, counters and the
    funnel, one for the profile and its percentiles. Returns the written tables, then funnel and percentiles.
    """
    require_unique_zones(zones)
    totals = cut_lineage(date_study.study_totals(trips, study))
    cuts = date_study.results_from_totals(cut_lineage(date_study.cuts_from_totals(totals, zones)), study)
    measured = date_study.from_measures(cut_lineage(date_study.measures(trips, study)))
    shown = {
        "row_funnel": date_study.funnel_from_totals(trips, totals, zones, study),
        "approx_percentiles": measured.pop("approx_percentiles"),
    }
    quality = date_study.quality_from_totals(totals, study) | measured
    for name, result in cuts.items():
        write_single_csv(result, f"{out}/{name}")
    for name, result in quality.items():
        write_single_csv(result, f"{out}/eda/{name}")
    spark = trips.sparkSession
    paths = {name: f"{out}/{name}" for name in cuts} | {name: f"{out}/eda/{name}" for name in quality}
    return {name: read_result(spark, path, name) for name, path in paths.items()} | shown


def run_month_study(
    trips: DataFrame, zones: DataFrame, out: str, study: MonthStudy = MonthStudy()
) -> dict[str, DataFrame]:
    """Writes the five result tables to ``out``, all fields quoted; one scan of the trips.

    Returns the written tables.
    """
    require_unique_zones(zones)
    results = month_study.results_from_totals(
        cut_lineage(month_study.shared_totals(trips, zones, study)), study
    )
    for name, result in results.items():
        write_single_csv(result, f"{out}/{name}", quote_all=True)
    return {name: read_result(trips.sparkSession, f"{out}/{name}", name) for name in results}


def require_unique_zones(zones: DataFrame) -> None:
    """A repeated zone id would count its trips once per repetition."""
    repeated = repeated_zone_ids(zones).limit(5).collect()
    if repeated:
        raise ValueError(f"zone ids occur more than once, for example {[r[0] for r in repeated]}")


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    dates = jobs.add_parser("date-study", help="date-range cohorts, from files")
    dates.add_argument("--trips", nargs="+", required=True, help="Parquet paths or globs")
    dates.add_argument("--zones", required=True, help="zone lookup CSV")
    dates.add_argument("--out", required=True)
    dates.add_argument("--month-folders", action="store_true", help="trips are laid out by by-month")
    months = jobs.add_parser("month-study", help="month-set cohorts, from catalog tables")
    months.add_argument("--database", required=True)
    months.add_argument("--out", required=True)
    months.add_argument("--month-folders", action="store_true", help="the table was registered so")
    tables = jobs.add_parser("register", help="create the database and both external tables")
    tables.add_argument("--database", required=True)
    tables.add_argument("--trips", required=True, help="folder of Parquet files")
    tables.add_argument("--zones", required=True, help="folder of the zone lookup CSV")
    tables.add_argument("--month-folders", action="store_true", help="trips are laid out by by-month")
    layout = jobs.add_parser("by-month", help="rewrite trips with one folder per month")
    layout.add_argument("--trips", nargs="+", required=True)
    layout.add_argument("--out", required=True)
    report = jobs.add_parser("report", help="show report tables of written results")
    report.add_argument("--date-results")
    report.add_argument("--month-results")
    report.add_argument("--out", help="folder for the whole report tables")
    chosen = parser.parse_args(arguments)
    spark = build_session(f"tripcohorts {chosen.job}")
    try:
        _RUNNERS[chosen.job](spark, chosen)
    finally:
        remove_checkpoints(spark)


def _date_job(spark: SparkSession, chosen: argparse.Namespace) -> None:
    trips, zones = read_trips(spark, *chosen.trips), read_zones(spark, chosen.zones)
    study = DateStudy()
    if chosen.month_folders:
        study = replace(study, cohorts=in_month_folders(study.cohorts))
    results = run_date_study(trips, zones, chosen.out, study)
    show(results | {"tail_percentiles": date_study.tail_percentiles(trips, study)})


def _month_job(spark: SparkSession, chosen: argparse.Namespace) -> None:
    trips, zones = registered_tables(spark, chosen.database, chosen.month_folders)
    study = MonthStudy()
    if chosen.month_folders:
        study = replace(study, cohorts=in_month_folders(study.cohorts))
    show({"total_row_count": month_study.total_row_count(trips)})
    show(run_month_study(trips, zones, chosen.out, study))


def _register_job(spark: SparkSession, chosen: argparse.Namespace) -> None:
    for table in register_tables(spark, chosen.database, chosen.trips, chosen.zones, chosen.month_folders):
        table.printSchema()


def _layout_job(spark: SparkSession, chosen: argparse.Namespace) -> None:
    write_monthly(read_trips(spark, *chosen.trips), chosen.out)


def _report_job(spark: SparkSession, chosen: argparse.Namespace) -> None:
    tables: dict[str, DataFrame] = {}
    if chosen.date_results:
        tables |= reports.date_reports(spark, chosen.date_results)
    if chosen.month_results:
        tables |= reports.month_reports(spark, chosen.month_results)
    if chosen.out:
        for name, table in tables.items():
            write_single_csv(table, f"{chosen.out}/{name}")
    show(tables)


_RUNNERS = {
    "date-study": _date_job,
    "month-study": _month_job,
    "register": _register_job,
    "by-month": _layout_job,
    "report": _report_job,
}


def show(tables: dict[str, DataFrame]) -> None:
    """Prints the first rows of each table, and how many there are beyond; a table is computed once."""
    for name, table in tables.items():
        print(name)
        kept = cut_lineage(table)
        kept.show(PREVIEW_ROWS, truncate=False)
        more = kept.count() - PREVIEW_ROWS
        if more > 0:
            print(f"{more} more rows are not shown")


if __name__ == "__main__":
    main()

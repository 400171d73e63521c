from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from pathlib import Path
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import explained, trip, trips, values, zones
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tripcohorts import session
from tripcohorts.config import HOLIDAY, DateStudy, MonthStudy
from tripcohorts.functions.cohorts import in_month_folders
from tripcohorts.plans import date_study, jobs, month_study, reports
from tripcohorts.schemas import RESULT_SCHEMAS, TRIP_SCHEMA, ZONE_SCHEMA
from tripcohorts.sinks.monthly import write_monthly
from tripcohorts.sinks.results import write_single_csv
from tripcohorts.sources import catalog, tables
from tripcohorts.sources.results import read_result
from tripcohorts.sources.tables import read_trips, read_zones, schema_problems

LOOKUP_CSV = '"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n50,"Manhattan","A, B","Yellow Zone"\n264,"N/A","N/A","N/A"\n'


@pytest.fixture
def lookup_folder(tmp_path):
    folder = tmp_path / "lookup"
    folder.mkdir()
    (folder / "zones.csv").write_text(LOOKUP_CSV)
    return str(folder)


def month_files(spark, folder: Path) -> None:
    for month in (3, 12):
        rows = [
            trip(tpep_pickup_datetime=datetime(2025, month, day, hour), tip_amount=(day % 4) / 2, payment_type=2 if day == 15 else 1)
            for day in (1, 15, 31)
            for hour in (0, 12, 23)
        ]
        trips(spark, rows).coalesce(1).write.parquet(str(folder / f"trips_2025-{month:02d}.parquet"))


def test_many_files_are_one_table(spark, tmp_path):
    month_files(spark, tmp_path)
    table = read_trips(spark, str(tmp_path / "trips_*.parquet"))
    assert table.count() == 18 and table.schema == TRIP_SCHEMA


@pytest.mark.parametrize("change", ["drop", "retype"])
def test_a_file_without_a_used_column_is_refused(spark, tmp_path, change):
    month_files(spark, tmp_path)
    good = spark.read.parquet(str(tmp_path / "trips_2025-03.parquet"))
    bad = good.drop("tip_amount") if change == "drop" else good.withColumn("tip_amount", F.lit("1"))
    bad.write.parquet(str(tmp_path / "trips_2025-04.parquet"))
    with pytest.raises(ValueError, match="trips_2025-04.*tip_amount"):
        read_trips(spark, str(tmp_path / "trips_*.parquet"))


def small_files(folder: Path, count: int) -> None:
    table = pa.table({f.name: pa.array([1], to_arrow_type(f.dataType)) for f in TRIP_SCHEMA if f.name in tables.USED_COLUMNS})
    folder.mkdir()
    for i in range(count):
        pq.write_table(table, folder / f"part {i:04d}%20.parquet")


def jobs_of(spark, work) -> int:
    group = f"counted {id(work)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_footers_of_many_files_are_read_by_one_job(spark, tmp_path):
    small_files(tmp_path / "many", 500)
    assert jobs_of(spark, lambda: read_trips(spark, str(tmp_path / "many"))) == 1
    assert tables.footers(spark, [str(tmp_path / "many")], ["FARE_amount"]).count() == 500
    bad = pa.table({"fare_amount": pa.array(["1"]), "tip_amount": pa.array([1], pa.uint64())})
    pq.write_table(bad, tmp_path / "many" / "part 0300 bad.parquet")
    (tmp_path / "many" / "part 0400 text.parquet").write_text("not a table")

    def refused():
        with pytest.raises(ValueError) as error:
            read_trips(spark, str(tmp_path / "many"))
        message = str(error.value)
        assert "part 0300 bad.parquet: missing column tpep_pickup_datetime; " in message
        assert "bad.parquet: column fare_amount is string, not double; " in message
        assert "column tip_amount is decimal(20,0), not double" in message
        assert "text.parquet: its footer cannot be read" in message and message.endswith("; and 4 more")

    assert jobs_of(spark, refused) <= 2  # AQE may run the sort's stages apart


def test_a_store_that_only_spark_reads(spark, tmp_path, monkeypatch):
    small_files(tmp_path / "many", 3)
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("fs.viewfs.mounttable.store.link./in", f"file://{tmp_path}/many")
    assert read_trips(spark, "viewfs://store/in").count() == 3
    pq.write_table(pa.table({"fare_amount": pa.array([1.0])}), tmp_path / "many" / "lacks some.parquet")
    assert read_trips(spark, "viewfs://store/in").count() == 4  # which a merged schema does not show
    for file in (tmp_path / "many").glob("part*"):
        pq.write_table(pa.table({"fare_amount": pa.array([1.0])}), file)
    with pytest.raises(ValueError, match="viewfs.*missing column tip_amount"):
        read_trips(spark, "viewfs://store/in")


def test_files_may_differ_in_columns_that_are_not_read(spark, tmp_path):
    month_files(spark, tmp_path)
    other = spark.read.parquet(str(tmp_path / "trips_2025-03.parquet"))
    other.withColumn("passenger_count", F.lit(1).cast("long")).withColumnRenamed("Airport_fee", "airport_fee").write.parquet(
        str(tmp_path / "trips_2025-04.parquet")
    )
    table = read_trips(spark, str(tmp_path / "trips_*.parquet"))
    assert sum(r["trip_count"] for r in month_study.period_summary(table).collect()) > 0


def test_zone_lookup_types_quotes_and_na(spark, lookup_folder):
    table = read_zones(spark, lookup_folder)
    assert table.schema == ZONE_SCHEMA
    assert (50, "Manhattan", "A, B", "Yellow Zone") in values(table)
    assert table.filter("Borough = 'N/A'").count() == 1
    inferred = read_zones(spark, lookup_folder, infer_types=True)
    assert dict(inferred.dtypes)["LocationID"] == "int"
    assert sorted(values(inferred)) == sorted(values(table))


def test_zone_lookup_goes_by_header_names(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('"service_zone","Zone","LocationID","Borough"\n"EWR","Newark Airport","1","Newark"\n')
    assert values(read_zones(spark, str(path))) == [(1, "Newark", "Newark Airport", "EWR")]
    path.write_text('"LocationID","Zone","service_zone"\n"1","a","b"\n')
    with pytest.raises(ValueError, match="Borough"):
        read_zones(spark, str(path))


def test_schema_problems(spark):
    frame = trips(spark, []).withColumn("fare_amount", F.lit("x")).drop("tip_amount").withColumnRenamed("VendorID", "vendorid")
    assert schema_problems(frame, TRIP_SCHEMA) == [
        "column fare_amount is string, not double",
        "missing column tip_amount",
    ]


def test_catalog_tables(spark, tmp_path, lookup_folder):
    month_files(spark, tmp_path / "trips")
    stored = spark.read.parquet(str(tmp_path / "trips" / "*.parquet"))
    stored.write.parquet(str(tmp_path / "table"))
    for _ in range(2):  # repeating it changes nothing
        table, lookup = catalog.register_tables(spark, "study_db", str(tmp_path / "table"), lookup_folder)
    assert table.schema == TRIP_SCHEMA and lookup.schema == ZONE_SCHEMA
    assert spark.sql("SELECT count(*) AS total_rows FROM study_db.yellow_taxi_trips").first()[0] == 18
    assert values(month_study.total_row_count(table)) == [(18,)]
    by_sql = spark.sql(
        """SELECT z.borough, count(*) FROM study_db.yellow_taxi_trips t
           LEFT JOIN study_db.taxi_zone_lookup z ON t.PULocationID = z.LocationID
           WHERE t.fare_amount > 0 AND t.tip_amount / t.fare_amount <= 1 GROUP BY z.borough"""
    )
    assert values(by_sql) == [("Manhattan", 18)]
    assert month_study.tip_rate_by_borough(table, lookup).count() == 2


def test_a_lookup_with_another_header_is_refused(spark, tmp_path):
    month_files(spark, tmp_path / "trips")
    folder = tmp_path / "reordered"
    folder.mkdir()
    (folder / "zones.csv").write_text('"Borough","LocationID","Zone","service_zone"\n"EWR","1","Newark","EWR"\n')
    _, lookup = catalog.register_tables(spark, "reordered_db", str(tmp_path / "trips" / "trips_2025-03.parquet"), str(folder))
    with pytest.raises(Exception, match="header"):
        lookup.collect()


def test_tables_by_month_read_their_folders_only(spark, tmp_path, lookup_folder, capsys):
    month_files(spark, tmp_path)
    write_monthly(read_trips(spark, str(tmp_path / "trips_*.parquet")), str(tmp_path / "by_month"))
    for _ in range(2):
        table, lookup = catalog.register_tables(spark, "month_db", str(tmp_path / "by_month"), lookup_folder, month_folders=True)
    assert spark.sql("SHOW PARTITIONS month_db.yellow_taxi_trips").count() == 2
    study = MonthStudy()
    study = replace(study, cohorts=in_month_folders(study.cohorts))
    rows = month_study.tip_rate_by_borough(table, lookup, study)
    assert values(rows) == values(month_study.tip_rate_by_borough(read_trips(spark, str(tmp_path / "trips_*.parquet")), lookup))
    plan = explained(rows)
    assert "PartitionFilters: [" in plan and "trip_month" in plan.split("PartitionFilters: ")[1].splitlines()[0]
    assert "tpep_pickup_datetime" not in plan.split("ReadSchema: ")[1].splitlines()[0]
    jobs.main(["month-study", "--database", "month_db", "--out", str(tmp_path / "cloud"), "--month-folders"])
    assert "tip_rate_by_borough" in capsys.readouterr().out
    # a month that comes later is known after the next call
    more = trips(spark, [trip(tpep_pickup_datetime=datetime(2025, 9, 1))]).withColumn("trip_month", F.lit(202509))
    more.write.mode("append").partitionBy("trip_month").parquet(str(tmp_path / "by_month"))
    table, _ = catalog.register_tables(spark, "month_db", str(tmp_path / "by_month"), lookup_folder, month_folders=True)
    assert table.filter("trip_month = 202509").count() == 1


def test_tables_of_others_are_looked_at_before_the_study(spark, tmp_path, lookup_folder):
    month_files(spark, tmp_path)
    catalog.register_tables(spark, "plain_db", str(tmp_path / "trips_2025-03.parquet"), lookup_folder)
    assert len(catalog.registered_tables(spark, "plain_db")) == 2
    with pytest.raises(ValueError, match="no folders by trip_month"):
        catalog.registered_tables(spark, "plain_db", month_folders=True)
    spark.sql("CREATE DATABASE IF NOT EXISTS bad_db")
    spark.sql("CREATE TABLE IF NOT EXISTS bad_db.taxi_zone_lookup (LocationID INT) USING parquet")
    spark.sql("CREATE TABLE IF NOT EXISTS bad_db.yellow_taxi_trips (fare_amount STRING) USING parquet")
    with pytest.raises(ValueError, match="bad_db: missing column tpep_pickup_datetime.*column LocationID is int"):
        catalog.registered_tables(spark, "bad_db")


def test_one_csv_part_in_order_replaced_on_rewrite(spark, tmp_path):
    frame = spark.range(0, 200, 1, 4).select(F.col("id"), (F.col("id") % 7).alias("k"))
    path = str(tmp_path / "out")
    for _ in range(2):
        write_single_csv(frame.orderBy(F.desc("k"), "id"), path)
    (part,) = Path(path).glob("*.csv")
    lines = part.read_text().splitlines()
    assert lines[0] == "id,k" and len(lines) == 201
    assert [tuple(map(int, line.split(","))) for line in lines[1:]] == sorted(((i, i % 7) for i in range(200)), key=lambda r: (-r[1], r[0]))


def test_results_survive_csv(spark, tmp_path):
    schema = RESULT_SCHEMAS["credit_card_tip_rate_by_borough"]
    rows = [(HOLIDAY, "N/A", 3, 0.01, 0.0007, 5.0), (HOLIDAY, "A, B", 4, 1.5, 0.25, 6.0), (HOLIDAY, None, 5, 1.5, 0.25, 6.0)]
    write_single_csv(spark.createDataFrame(rows, schema).orderBy("trip_count"), str(tmp_path / "plain"))
    write_single_csv(spark.createDataFrame(rows, schema).orderBy("trip_count"), str(tmp_path / "quoted"), quote_all=True)
    (part,) = (tmp_path / "plain").glob("*.csv")
    assert "7.0E-4" in part.read_text()
    (quoted,) = (tmp_path / "quoted").glob("*.csv")
    assert quoted.read_text().splitlines()[1].startswith('"Holiday Season","N/A","3"')
    for path in (tmp_path / "plain", tmp_path / "quoted", quoted):
        assert values(read_result(spark, str(path), "credit_card_tip_rate_by_borough")) == rows


def test_missing_results_are_empty_tables(spark, tmp_path):
    table = read_result(spark, str(tmp_path / "nothing"), "tip_rate_by_hour")
    assert table.count() == 0 and table.schema == RESULT_SCHEMAS["tip_rate_by_hour"]
    for report in {**reports.date_reports(spark, str(tmp_path)), **reports.month_reports(spark, str(tmp_path))}.values():
        assert report.count() == 0


def test_filters_and_columns_reach_the_scan(spark, tmp_path, lookup_folder):
    month_files(spark, tmp_path)
    table = read_trips(spark, str(tmp_path / "trips_*.parquet"))
    plan = explained(month_study.tip_rate_by_borough(table, read_zones(spark, lookup_folder)))
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters") and "fare_amount" in line)
    for part in (
        "EqualTo(payment_type,1)",
        "GreaterThan(fare_amount,0.0)",
        "LessThan(fare_amount,100.0)",
        "GreaterThanOrEqual(tpep_pickup_datetime,2023-03-01",
        "IsNotNull(PULocationID)",
    ):
        assert part in pushed
    read = next(line for line in plan.splitlines() if line.startswith("ReadSchema") and "fare_amount" in line)
    assert read.count(":") == 1 + 6 and "passenger_count" not in read
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_date_job(spark, tmp_path, lookup_folder):
    month_files(spark, tmp_path)
    table, lookup = read_trips(spark, str(tmp_path / "trips_*.parquet")), read_zones(spark, lookup_folder)
    out = str(tmp_path / "results")
    jobs.run_date_study(table, lookup, out)
    expected = date_study.credit_card_holiday_vs_normal(table)
    name = "credit_card_holiday_vs_normal"
    assert values(read_result(spark, f"{out}/{name}", name)) == values(expected)
    for name in ("raw_summary_statistics", "invalid_record_counts", "high_tip_trips_by_period"):
        assert len(list(Path(out, "eda", name).glob("*.csv"))) == 1
    for name in date_study.CUTS:
        assert len(list(Path(out, name).glob("*.csv"))) == 1
        frame = read_result(spark, f"{out}/{name}", name)
        assert frame.schema == RESULT_SCHEMAS[name]
    shown = reports.date_reports(spark, out)
    assert shown["cohort_delta"].first()["baseline_trips"] == expected.filter("period = 'Normal Baseline'").first()["trip_count"]
    assert shown[f"hour_curve {HOLIDAY}"].count() == 3


def test_month_job(spark, tmp_path, lookup_folder):
    month_files(spark, tmp_path)
    table, lookup = read_trips(spark, str(tmp_path / "trips_*.parquet")), read_zones(spark, lookup_folder)
    jobs.run_month_study(table, lookup, str(tmp_path / "cloud"))
    assert sorted(p.name for p in (tmp_path / "cloud").iterdir()) == sorted(month_study.CUTS)
    for name in month_study.CUTS:
        assert read_result(spark, str(tmp_path / "cloud" / name), name).schema == RESULT_SCHEMAS[name]
    shown = reports.month_reports(spark, str(tmp_path / "cloud"))
    assert shown["real_borough_rates"].count() == 2


def test_month_layout_gives_the_same_results(spark, tmp_path):
    month_files(spark, tmp_path)
    table = read_trips(spark, str(tmp_path / "trips_*.parquet"))
    write_monthly(table, str(tmp_path / "monthly"))
    stored = read_trips(spark, str(tmp_path / "monthly"))
    assert "trip_month" in stored.columns
    for study, analysis in (
        (MonthStudy(), month_study.tip_rate_by_hour),
        (DateStudy(), date_study.all_valid_holiday_vs_normal),
    ):
        in_folders = replace(study, cohorts=in_month_folders(study.cohorts))
        assert values(analysis(stored, in_folders)) == values(analysis(table, study)) == values(analysis(stored, study))


def test_a_month_with_most_trips_is_split_over_files(spark, tmp_path):
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    minute = F.expr("timestamp_ntz'2025-12-01 00:00:00' + make_dt_interval(0, 0, cast(id % 44640 as int))")
    hot = spark.range(0, 200_000, 1, 8).select(minute.alias("tpep_pickup_datetime"), F.col("id").alias("VendorID"))
    cold = hot.limit(50).withColumn("tpep_pickup_datetime", F.expr("timestamp_ntz'2025-03-01 00:00:00'"))
    spark.conf.set(advisory, "200k")
    try:
        write_monthly(hot.unionByName(cold), str(tmp_path / "hot"))
    finally:
        spark.conf.set(advisory, before)
    assert len(list((tmp_path / "hot" / "trip_month=202512").glob("*.parquet"))) > 3
    assert len(list((tmp_path / "hot" / "trip_month=202503").glob("*.parquet"))) == 1
    assert spark.read.parquet(str(tmp_path / "hot")).count() == 200_050


def test_jobs_refuse_repeated_zone_ids(spark, tmp_path):
    with pytest.raises(ValueError, match="50"):
        jobs.run_date_study(trips(spark, [trip()]), zones(spark, [(50, "a", "a"), (50, "b", "b")]), str(tmp_path / "x"))


def test_command_line(spark, tmp_path, lookup_folder, capsys):
    month_files(spark, tmp_path)
    pattern, out = str(tmp_path / "trips_*.parquet"), str(tmp_path / "cli")
    jobs.main(["date-study", "--trips", pattern, "--zones", lookup_folder, "--out", out])
    jobs.main(["by-month", "--trips", pattern, "--out", str(tmp_path / "by_month")])
    jobs.main(["register", "--database", "cli_db", "--trips", str(tmp_path / "trips_2025-03.parquet"), "--zones", lookup_folder])
    jobs.main(["month-study", "--database", "cli_db", "--out", str(tmp_path / "cli_month")])
    jobs.main(["report", "--date-results", out, "--month-results", str(tmp_path / "cli_month")])
    shown = capsys.readouterr().out
    for text in ("study_period", "cohort_delta", "borough_period_pivot", "total_rows", "root"):
        assert text in shown


def test_lineage_is_cut_in_the_configured_folder(spark):
    frame = session.cut_lineage(spark.range(10).withColumn("x", F.col("id") * 2))
    assert frame.count() == 10
    assert "Scan ExistingRDD" in explained(frame)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert configured.rstrip("/") in spark.sparkContext.getCheckpointDir()


def test_month_layout_does_not_replace_its_input(spark, tmp_path):
    month_files(spark, tmp_path / "in")
    table = spark.read.parquet(str(tmp_path / "in" / "*.parquet"))
    for out in (tmp_path / "in", tmp_path, tmp_path / "in" / "trips_2025-03.parquet"):
        with pytest.raises(ValueError, match="input"):
            write_monthly(table, str(out))
    assert table.count() == 18


def counting(spark, table):
    """The table, and how many of its rows were read."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return table.mapInArrow(counted, table.schema), seen


def test_scans_of_the_date_job(spark, tmp_path, lookup_folder, monkeypatch, capsys):
    """One for the raw count, one for cuts, counters and funnel, one for the profile, four for exact percentiles at most."""
    month_files(spark, tmp_path)
    table, seen = counting(spark, read_trips(spark, str(tmp_path / "trips_*.parquet")))
    monkeypatch.setattr(jobs, "read_trips", lambda *_: table)
    monkeypatch.setattr(jobs.date_study, "tail_percentiles", lambda trips, study: trips.limit(0))
    chosen = SimpleNamespace(trips=["x"], zones=lookup_folder, out=str(tmp_path / "out"), month_folders=False)
    jobs._date_job(spark, chosen)
    assert seen.value == 3 * 18
    shown = capsys.readouterr().out
    assert "row_funnel" in shown and "approx_percentiles" in shown


def test_previews_compute_a_table_once(spark, capsys):
    table, seen = counting(spark, spark.range(300))
    jobs.show({"long": table})
    assert "200 more rows" in capsys.readouterr().out and seen.value == 300


def test_study_totals_give_what_single_scans_give(spark, tmp_path, lookup_folder):
    odd = [
        trip(fare_amount=-1.0), trip(fare_amount=0.0), trip(tip_amount=-2.0), trip(PULocationID=None), trip(DOLocationID=None),
        trip(payment_type=None), trip(trip_distance=None), trip(tip_amount=30.0), trip(tip_amount=float("inf")),
        trip(fare_amount=10.0, tip_amount=6.0), trip(PULocationID=1), trip(PULocationID=9999), trip(payment_type=2),
        trip(tpep_pickup_datetime=datetime(2025, 12, 4, 5)), trip(tpep_pickup_datetime=datetime(2024, 12, 4, 5)), trip(fare_amount=None),
    ]
    table, lookup = trips(spark, odd * 3), read_zones(spark, lookup_folder)
    totals = date_study.study_totals(table)
    quality = date_study.quality_from_totals(totals)
    assert values(quality["invalid_record_counts"]) == values(date_study.invalid_record_counts(table))
    assert values(quality["high_tip_trips_by_period"]) == values(date_study.high_tip_trips_by_period(table))
    assert values(date_study.funnel_from_totals(table, totals, lookup)) == values(date_study.row_funnel(table, lookup))
    ours = date_study.results_from_totals(date_study.cuts_from_totals(totals, lookup))
    single = date_study.results_from_totals(date_study.shared_totals(table, lookup))
    assert {name: values(rows) for name, rows in ours.items()} == {name: values(rows) for name, rows in single.items()}


def test_date_job_scans_the_trips_four_times(spark, tmp_path, lookup_folder):
    month_files(spark, tmp_path)
    table, lookup = read_trips(spark, str(tmp_path / "trips_*.parquet")), read_zones(spark, lookup_folder)
    context, seen = spark.sparkContext, spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    jobs.run_date_study(table.mapInArrow(counted, table.schema), lookup, str(tmp_path / "results"))
    assert context is spark.sparkContext and seen.value <= 3 * 18


def test_previews_say_what_they_leave_out(spark, capsys):
    jobs.show({"long": spark.range(jobs.PREVIEW_ROWS + 5), "short": spark.range(3)})
    printed = capsys.readouterr().out
    assert "5 more rows" in printed and printed.count("more rows") == 1

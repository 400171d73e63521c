from __future__ import annotations

import pytest
from helpers import explained, trip, trips, values, zones
from pyspark.sql import functions as F

from tripcohorts.config import DateStudy, MonthStudy
from tripcohorts.operators import zones as zone_ops
from tripcohorts.operators.cuts import trip_summary
from tripcohorts.plans import date_study, month_study

LOOKUP = [(50, "Manhattan", "A, B"), (132, "Queens", "JFK"), (264, "N/A", "N/A"), (7, "Queens", "Astoria")]


@pytest.fixture(scope="module")
def lookup(spark):
    return zone_ops.zone_dimension(zones(spark, LOOKUP))


@pytest.fixture(scope="module")
def many(spark):
    """Half of the trips are copies of one trip, one in six has no zone, one in six an unknown one."""
    ids = [50, 50, 50, None, 999, 132, 264, 7, 50, 50, None, 999] * 25
    rows = [trip(PULocationID=z, tip_amount=i % 7 * 0.25, fare_amount=8.0) for i, z in enumerate(ids)]
    return trips(spark, rows).repartition(5)


def test_empty_lookup_keeps_all_trips(spark, many):
    none = zone_ops.zone_dimension(zones(spark, []))
    joined = zone_ops.join_zones(many, none)
    assert joined.count() == many.count()
    assert joined.filter("pickup_zone is not null").count() == 0


def test_grouping_after_the_join_equals_grouping_by_id_first(many, lookup):
    keys = ["pickup_borough", "pickup_zone"]
    rated = many.withColumn("tip_rate", F.col("tip_amount") / F.col("fare_amount"))
    totals = zone_ops.zone_totals(rated, lookup, [])
    expected = trip_summary(zone_ops.join_zones(rated, lookup), keys)
    assert sorted(values(trip_summary(totals, keys, totals=True)), key=repr) == sorted(values(expected), key=repr)


def test_no_job_runs_while_a_query_is_built(spark, many):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "queries with zones")
    table = zones(spark, LOOKUP)
    month_study.tip_rate_by_borough(many, table)
    month_study.shared_totals(many, table)
    date_study.shared_totals(many, table)
    date_study.joined_trips(many, table)
    assert not tracker.getJobIdsForGroup("building")
    spark.sparkContext.setJobGroup("tests", "tests")


def test_trips_are_scanned_once_and_copied_never(spark, many, tmp_path):
    many.write.parquet(str(tmp_path / "trips"))
    stored = spark.read.parquet(str(tmp_path / "trips"))
    for study in (month_study, date_study):
        plan = stored.sparkSession._jvm.PythonSQLUtils.explainString(
            study.shared_totals(stored, zones(spark, LOOKUP))._jdf.queryExecution(), "simple"
        )
        plan = plan.split("== Initial Plan ==")[0]
        assert plan.count("FileScan parquet") == 1
        below = plan[plan.index("Expand") :]
        assert "HashAggregate" in below and below.index("HashAggregate") < below.index("FileScan")


def test_unmatched_trips_are_a_group_only_in_the_date_study(spark, many):
    table = zones(spark, LOOKUP)
    by_borough = {r["pickup_borough"]: r["trip_count"] for r in date_study.credit_card_tip_rate_by_borough(many, table).collect()}
    assert by_borough == {None: 50, "Manhattan": 125, "Queens": 50, "N/A": 25}
    month = {r["borough"]: r["trip_count"] for r in month_study.tip_rate_by_borough(many, table).collect()}
    assert month == {"Manhattan": 125, "Queens": 50, "N/A": 25}


def test_borough_filter_turns_the_join_inner(spark, many):
    plan = explained(month_study.tip_rate_by_borough(many, zones(spark, LOOKUP)))
    assert "Inner" in plan and "LeftOuter" not in plan


def test_repeated_ids_are_found_and_audited(spark, many):
    table = zones(spark, [*LOOKUP, (50, "Manhattan", "again")])
    assert values(zone_ops.repeated_zone_ids(table)) == [(50, 2)]
    dimension = zone_ops.zone_dimension(table)
    assert values(zone_ops.join_audit(many, dimension)) == [(300, 425)]
    assert zone_ops.join_zones(many, dimension).count() == 425
    assert values(zone_ops.join_audit(many, zone_ops.zone_dimension(zones(spark, LOOKUP)))) == [(300, 300)]
    assert values(zone_ops.join_audit(many.limit(0), dimension)) == [(0, 0)]


def test_funnel(spark):
    rows = [
        trip(),
        trip(payment_type=2),
        trip(fare_amount=0.0),
        trip(tpep_pickup_datetime=None),
        trip(PULocationID=None),
    ]
    frame = trips(spark, rows)
    stages = dict(values(date_study.row_funnel(frame, zones(spark, LOOKUP))))
    assert stages == {"raw": 5, "study_period": 4, "cleaned": 2, "joined": 2, "credit_card": 1}
    doubled = zones(spark, [*LOOKUP, (50, "Manhattan", "again")])
    stages = dict(values(date_study.row_funnel(frame, doubled)))
    assert stages["cleaned"] == 2 and stages["joined"] == 4 and stages["credit_card"] == 2


def test_raw_count_reads_no_column(spark, many, tmp_path):
    many.write.parquet(str(tmp_path / "trips"))
    stored = spark.read.parquet(str(tmp_path / "trips"))
    plan = explained(date_study.row_funnel(stored, zones(spark, LOOKUP)))
    assert "ReadSchema: struct<>" in plan


def test_study_settings_are_values():
    assert DateStudy().cohorts.labels == ("Normal Baseline", "Holiday Season")
    assert MonthStudy().control_min_trips == 10_000 and DateStudy().zone_min_trips == 1_000

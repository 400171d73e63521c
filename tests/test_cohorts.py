from __future__ import annotations

import re
from dataclasses import replace
from datetime import date, datetime, timedelta

from helpers import explained, trip, trips, values
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripcohorts.config import DateStudy, MonthStudy
from tripcohorts.functions import cohorts
from tripcohorts.functions.features import PICKUP_TIME, add_calendar
from tripcohorts.plans import date_study, month_study
from tripcohorts.sinks.monthly import write_monthly
from tripcohorts.sources import star

MONTHS = MonthStudy().cohorts
DATES = DateStudy().cohorts


def label_of(spark, rule, moment):
    frame = trips(spark, [trip(tpep_pickup_datetime=moment)])
    return frame.select(rule.label(PICKUP_TIME)).first()[0]


def test_date_ranges_include_their_last_second(spark):
    assert label_of(spark, DATES, datetime(2025, 12, 31, 23, 59, 59)) == "Holiday Season"
    assert label_of(spark, DATES, datetime(2025, 3, 1)) == "Normal Baseline"
    assert label_of(spark, DATES, datetime(2025, 4, 1)) == "Outside Study Period"
    assert label_of(spark, DATES, None) == "Outside Study Period"


def test_month_sets(spark):
    assert label_of(spark, MONTHS, datetime(2023, 1, 15)) == "Holiday Season"
    assert label_of(spark, MONTHS, datetime(2024, 10, 31, 23)) == "Normal Baseline"
    assert label_of(spark, MONTHS, datetime(2024, 6, 1)) == "Other"


def test_windows_of_neighbouring_months_are_joined():
    windows = cohorts.all_windows(MONTHS)
    assert windows[0] == (date(2023, 1, 1), date(2023, 2, 1))
    assert (date(2023, 9, 1), date(2024, 2, 1)) in windows
    assert len(windows) == 7
    assert cohorts.merge_windows([(date(2025, 1, 1), date(2025, 1, 9)), (date(2025, 1, 3), date(2025, 1, 5))]) == [
        (date(2025, 1, 1), date(2025, 1, 9))
    ]


days = st.dates(date(2023, 11, 1), date(2025, 3, 1))


@given(st.lists(st.tuples(days, st.integers(1, 80)), max_size=8))
def test_merged_windows_cover_the_same_days_without_touching(spans):
    windows = [(start, start + timedelta(days=length)) for start, length in spans]
    merged = cohorts.merge_windows(windows)
    assert covered(merged) == covered(windows)
    assert all(a[1] < b[0] for a, b in zip(merged, merged[1:]))
    assert cohorts.months_touched(merged) == sorted({d.year * 100 + d.month for d in covered(windows)})


def covered(windows):
    return {start + timedelta(days=i) for start, end in windows for i in range((end - start).days)}


def test_months_touched_by_odd_windows():
    assert cohorts.months_touched([(date(2024, 12, 20), date(2025, 2, 1))]) == [202412, 202501]
    assert not cohorts.whole_months([(date(2024, 12, 20), date(2025, 2, 1))])


def moments():
    """Every month of five years, at the borders and inside, and an unknown pickup."""
    first = [datetime(y, m, 1) for y in range(2022, 2027) for m in range(1, 13)]
    inside = [datetime(y, m, 28, 23, 59, 59) for y in range(2022, 2027) for m in range(1, 13)]
    return [*first, *inside, datetime(2025, 3, 31, 23, 59, 59), datetime(2025, 12, 31, 23, 59, 59), None]


def test_windows_and_labels_agree(spark):
    """Selecting by windows keeps what the label plus a year filter would keep."""
    frame = trips(spark, [trip(tpep_pickup_datetime=m) for m in moments()])
    by_label = frame.withColumn("study_period", MONTHS.label(PICKUP_TIME)).filter(
        (F.col("study_period") != "Other") & F.year(PICKUP_TIME).isin(2023, 2024, 2025)
    )
    selected = cohorts.select_cohorts(frame, PICKUP_TIME, MONTHS)
    assert sorted(values(selected.select(PICKUP_TIME, "study_period"))) == sorted(
        values(by_label.select(PICKUP_TIME, "study_period"))
    )
    by_day = frame.withColumn("period", DATES.label(PICKUP_TIME)).filter("period != 'Outside Study Period'")
    selected = cohorts.select_cohorts(frame, PICKUP_TIME, DATES)
    assert sorted(values(selected.select(PICKUP_TIME, "period"))) == sorted(
        values(by_day.select(PICKUP_TIME, "period"))
    )


def test_month_folders_give_the_same_trips_and_are_pruned(spark, tmp_path):
    frame = trips(spark, [trip(tpep_pickup_datetime=m) for m in moments()])
    write_monthly(frame, str(tmp_path / "monthly"))
    stored = spark.read.parquet(str(tmp_path / "monthly"))
    assert stored.count() == frame.count()
    for rule in (MONTHS, DATES):
        in_folders = cohorts.in_month_folders(rule)
        from_folders = cohorts.select_cohorts(stored, PICKUP_TIME, in_folders).select(PICKUP_TIME, rule.column)
        from_rows = cohorts.select_cohorts(frame, PICKUP_TIME, rule).select(PICKUP_TIME, rule.column)
        assert sorted(values(from_folders)) == sorted(values(from_rows))
    in_folders = cohorts.in_month_folders(DATES)
    plan = explained(cohorts.select_cohorts(stored, PICKUP_TIME, in_folders).groupBy("period").count())
    assert "PartitionFilters: [trip_month" in plan.replace("isnotnull(trip_month", "trip_month")
    assert "tpep_pickup_datetime" not in plan.split("ReadSchema:")[1].splitlines()[0]


def test_part_of_a_month_still_reads_the_timestamp(spark, tmp_path):
    frame = trips(spark, [trip(tpep_pickup_datetime=datetime(2025, 12, d, 12)) for d in range(1, 32)])
    write_monthly(frame, str(tmp_path / "monthly"))
    stored = spark.read.parquet(str(tmp_path / "monthly"))
    weeks = cohorts.DateCohorts({"a": (date(2025, 12, 24), date(2025, 12, 26)), "b": (date(2025, 12, 1), date(2025, 12, 7))}, month_column="trip_month")
    counts = dict(values(cohorts.select_cohorts(stored, PICKUP_TIME, weeks).groupBy("period").count()))
    assert counts == {"a": 3, "b": 7}


def test_calendar_columns(spark):
    frame = add_calendar(trips(spark, [trip(tpep_pickup_datetime=datetime(2025, 12, 31, 23, 59, 59))]))
    assert values(frame.select("pickup_date", "pickup_month", "pickup_hour")) == [(date(2025, 12, 31), 12, 23)]



def test_a_column_that_happens_to_be_called_so_decides_nothing(spark):
    frame = trips(spark, [trip(tpep_pickup_datetime=datetime(2025, 12, 5, 12))]).withColumn("trip_month", F.lit(3))
    for rule in (MONTHS, DATES):
        assert cohorts.select_cohorts(frame, PICKUP_TIME, rule).count() == 1


def optimized(frame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_a_computed_timestamp_is_evaluated_twice_at_most(spark):
    """Once to filter and once to label, whatever the number of windows."""
    study = star.MONTH_STUDY
    rows = star.trips(spark, "/root/testdata/sf0.001", study.cohorts)
    assert len(cohorts.all_windows(study.cohorts)) == 7
    for query in (
        month_study.period_summary(rows, study),
        date_study.all_valid_holiday_vs_normal(star.trips(spark, "/root/testdata/sf0.001"), star.DATE_STUDY),
    ):
        assert 1 <= len(re.findall(r"l_shipdate#\d+ \+ ", optimized(query))) <= 2


def test_a_stored_timestamp_is_filtered_by_ranges_at_the_scan(spark, tmp_path):
    trips(spark, [trip(tpep_pickup_datetime=m) for m in moments()]).write.parquet(str(tmp_path / "trips"))
    stored = spark.read.parquet(str(tmp_path / "trips"))
    plan = explained(cohorts.select_cohorts(stored, PICKUP_TIME, MONTHS).groupBy("study_period").count())
    pushed = plan.split("PushedFilters:")[1].splitlines()[0]
    assert pushed.count("GreaterThanOrEqual(tpep_pickup_datetime") == 7
    computed = replace(MONTHS, stored=False)
    by_lookup = cohorts.select_cohorts(stored, PICKUP_TIME, computed).select(PICKUP_TIME, "study_period")
    by_ranges = cohorts.select_cohorts(stored, PICKUP_TIME, MONTHS).select(PICKUP_TIME, "study_period")
    assert sorted(values(by_lookup)) == sorted(values(by_ranges))


def test_labels_of_many_overlapping_windows(spark):
    """The first label whose windows hold the day, over two centuries; NULL and far days have none."""
    ranges = {f"label {i}": (date(1900 + 9 * i, 1 + i % 12, 5), date(1912 + 9 * i, 1 + i % 7, 20)) for i in range(20)}
    rule = cohorts.DateCohorts(ranges)
    asked = [date(1890, 1, 1) + timedelta(days=61 * i) for i in range(1300)]
    frame = trips(spark, [trip(tpep_pickup_datetime=datetime(d.year, d.month, d.day, 23, 59, 59)) for d in asked] + [trip(tpep_pickup_datetime=None)])
    found = frame.select(F.to_date(PICKUP_TIME), rule.label(PICKUP_TIME)).collect()
    for day, label in found:
        wanted = next((name for name, (a, b) in ranges.items() if day and a <= day <= b), rule.other)
        assert label == wanted, day
    kept = cohorts.select_cohorts(frame, PICKUP_TIME, rule).count()
    assert kept == sum(label != rule.other for _, label in found)


def test_no_windows_select_nothing(spark):
    frame = trips(spark, [trip()])
    assert cohorts.select_cohorts(frame, PICKUP_TIME, cohorts.MonthCohorts({"none": ()}, (2024,), stored=False)).count() == 0

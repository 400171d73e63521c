from __future__ import annotations

from datetime import datetime

import pytest
from helpers import trip, trips, values
from pyspark.sql import functions as F

from tripcohorts.config import AIRPORT_IDS, DateStudy, MonthStudy, Thresholds
from tripcohorts.functions import features
from tripcohorts.operators import rules
from tripcohorts.plans import date_study, month_study


@pytest.mark.parametrize(
    "pickup, dropoff, direction, flag",
    [
        (132, 50, "Airport Inbound", "Airport Trip"),
        (50, 138, "Airport Outbound", "Airport Trip"),
        (1, 132, "Airport-to-Airport", "Airport Trip"),
        (50, 60, "Non-Airport", "Non-Airport Trip"),
        (None, 132, "Non-Airport", "Airport Trip"),
        (132, None, "Non-Airport", "Airport Trip"),
        (None, None, "Non-Airport", "Non-Airport Trip"),
    ],
)
def test_airport_labels(spark, pickup, dropoff, direction, flag):
    frame = trips(spark, [trip(PULocationID=pickup, DOLocationID=dropoff)])
    labels = frame.select(features.airport_direction(AIRPORT_IDS), features.airport_flag(AIRPORT_IDS))
    assert values(labels) == [(direction, flag)]


def test_ratio_of_zero_and_negative_fares(spark):
    frame = trips(spark, [trip(fare_amount=f) for f in (0.0, -5.0, 4.0, None)])
    assert values(frame.select(features.raw_tip_rate())) == [(None,), (None,), (0.5,), (None,)]
    assert frame.filter(features.tip_rate() <= 1).count() == 2  # no division error


def test_a_zero_fare_does_not_end_the_query(spark):
    frame = trips(spark, [trip(fare_amount=0.0, tip_amount=1.0), trip()])
    assert date_study.clean_trips(frame).count() == 1
    assert month_study.card_trips(frame, MonthStudy()).count() == 1


@pytest.mark.parametrize(
    "change, kept",
    [
        (dict(), True),
        (dict(fare_amount=100.0), False),
        (dict(fare_amount=99.99), True),
        (dict(fare_amount=90.0, tip_amount=25.0), False),
        (dict(trip_distance=25.0), False),
        (dict(trip_distance=0.0), False),
        (dict(tip_amount=0.0), True),
        (dict(tip_amount=-0.01), False),
        (dict(fare_amount=5.0, tip_amount=5.0), True),
        (dict(fare_amount=5.0, tip_amount=5.01), False),
        (dict(tip_amount=None), False),
    ],
)
def test_limits(spark, change, kept):
    frame = trips(spark, [trip(**change)])
    assert date_study.clean_trips(frame).count() == kept
    assert month_study.card_trips(frame, MonthStudy()).count() == kept


@pytest.mark.parametrize("key", ["PULocationID", "DOLocationID", "payment_type"])
def test_only_the_date_study_drops_unknown_keys(spark, key):
    frame = trips(spark, [trip(**{key: None})])
    assert date_study.clean_trips(frame).count() == 0
    assert month_study.card_trips(frame, MonthStudy()).count() == (0 if key == "payment_type" else 1)


def test_card_rule(spark):
    frame = trips(spark, [trip(payment_type=p) for p in (1, 2, None)])
    assert month_study.card_trips(frame, MonthStudy()).count() == 1
    assert date_study.clean_trips(frame).count() == 2
    assert date_study.card_trips(frame).count() == 1


def test_extreme_tips_include_both_edges(spark):
    rows = [
        trip(fare_amount=90.0, tip_amount=20.0),
        trip(fare_amount=10.0, tip_amount=5.0),
        trip(fare_amount=10.0, tip_amount=4.99),
        trip(fare_amount=0.0, tip_amount=50.0),
        trip(fare_amount=None, tip_amount=50.0),
    ]
    assert trips(spark, rows).filter(rules.is_extreme(Thresholds())).count() == 2


def test_defect_counters_count_unknown_amounts_as_no_defect(spark):
    rows = [
        trip(fare_amount=0.0),
        trip(fare_amount=None, tip_amount=None, trip_distance=None),
        trip(tip_amount=-1.0, trip_distance=0.0),
        trip(PULocationID=None, DOLocationID=None, payment_type=None),
    ]
    assert values(rules.count_defects(trips(spark, rows))) == [(4, 1, 1, 1, 1, 1, 1)]
    assert values(rules.count_defects(trips(spark, []))) == [(0, 0, 0, 0, 0, 0, 0)]


def test_non_null_ratios_are_rows_minus_non_positive_fares(spark):
    rows = [trip(fare_amount=f, tpep_pickup_datetime=datetime(2025, 12, 5)) for f in (-1.0, 0.0, 1.0, 2.0, 3.0)]
    study = date_study.study_trips(trips(spark, rows), DateStudy())
    counts = study.agg(F.count("*"), F.count_if(F.col("fare_amount") <= 0), F.count("raw_tip_rate")).first()
    assert counts[0] - counts[1] == counts[2] == 3

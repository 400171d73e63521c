"""Typed schemas: the two input tables and every result table."""

from __future__ import annotations

from pyspark.sql import types as T

_LONG, _DOUBLE, _STRING, _INT = T.LongType(), T.DoubleType(), T.StringType(), T.IntegerType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


# Column names and types of the input tables.
TRIP_SCHEMA = _schema(
    VendorID=_LONG,
    tpep_pickup_datetime=T.TimestampNTZType(),
    tpep_dropoff_datetime=T.TimestampNTZType(),
    passenger_count=_DOUBLE,
    trip_distance=_DOUBLE,
    RatecodeID=_DOUBLE,
    store_and_fwd_flag=_STRING,
    PULocationID=_LONG,
    DOLocationID=_LONG,
    payment_type=_LONG,
    fare_amount=_DOUBLE,
    extra=_DOUBLE,
    mta_tax=_DOUBLE,
    tip_amount=_DOUBLE,
    tolls_amount=_DOUBLE,
    improvement_surcharge=_DOUBLE,
    total_amount=_DOUBLE,
    congestion_surcharge=_DOUBLE,
    Airport_fee=_DOUBLE,
)
ZONE_SCHEMA = _schema(LocationID=_LONG, Borough=_STRING, Zone=_STRING, service_zone=_STRING)

_COUNT_TIP_RATE = dict(trip_count=_LONG, avg_tip_amount=_DOUBLE, avg_tip_rate=_DOUBLE)
_WITH_FARE = dict(_COUNT_TIP_RATE, avg_fare_amount=_DOUBLE)
_ALL_MEANS = dict(_WITH_FARE, avg_trip_distance=_DOUBLE)

# Result tables, by the folder or file name they are written under.
RESULT_SCHEMAS: dict[str, T.StructType] = {
    # date-range study
    "all_valid_holiday_vs_normal": _schema(period=_STRING, **_ALL_MEANS),
    "credit_card_holiday_vs_normal": _schema(period=_STRING, **_ALL_MEANS),
    "credit_card_tip_rate_by_borough": _schema(period=_STRING, pickup_borough=_STRING, **_WITH_FARE),
    "credit_card_tip_rate_by_hour": _schema(period=_STRING, pickup_hour=_INT, **_COUNT_TIP_RATE),
    "credit_card_airport_vs_non_airport": _schema(
        period=_STRING, airport_trip_flag=_STRING, **_ALL_MEANS
    ),
    "credit_card_top_zones_by_tip_rate": _schema(
        period=_STRING, pickup_borough=_STRING, pickup_zone=_STRING, **_WITH_FARE
    ),
    # data quality
    "raw_summary_statistics": _schema(
        summary=_STRING,
        fare_amount=_STRING,
        tip_amount=_STRING,
        trip_distance=_STRING,
        raw_tip_rate=_STRING,
    ),
    "invalid_record_counts": _schema(
        total_rows=_LONG,
        non_positive_fare=_LONG,
        negative_tip=_LONG,
        non_positive_distance=_LONG,
        missing_pickup_location=_LONG,
        missing_dropoff_location=_LONG,
        missing_payment_type=_LONG,
    ),
    "high_tip_trips_by_period": _schema(
        period=_STRING,
        high_tip_trip_count=_LONG,
        avg_high_tip_amount=_DOUBLE,
        avg_high_tip_rate=_DOUBLE,
        avg_fare_amount=_DOUBLE,
        avg_trip_distance=_DOUBLE,
    ),
    # month-set study
    "holiday_vs_baseline": _schema(study_period=_STRING, **_ALL_MEANS),
    "airport_direction": _schema(study_period=_STRING, airport_direction=_STRING, **_ALL_MEANS),
    "tip_rate_by_hour": _schema(study_period=_STRING, pickup_hour=_INT, **_ALL_MEANS),
    "tip_rate_by_borough": _schema(study_period=_STRING, borough=_STRING, **_ALL_MEANS),
    "zone_hour_controlled_comparison": _schema(
        borough=_STRING,
        pickup_hour=_INT,
        holiday_trips=_LONG,
        baseline_trips=_LONG,
        holiday_tip_rate=_DOUBLE,
        baseline_tip_rate=_DOUBLE,
        tip_rate_difference=_DOUBLE,
    ),
}

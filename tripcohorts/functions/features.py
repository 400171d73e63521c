"""Derived columns: calendar parts, tip ratios, airport labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PICKUP_TIME = "tpep_pickup_datetime"
PICKUP_ZONE = "PULocationID"
DROPOFF_ZONE = "DOLocationID"


def add_calendar(trips: DataFrame) -> DataFrame:
    """pickup_date, pickup_month, pickup_hour, all read off the timestamp as stored."""
    return trips.withColumns(
        {
            "pickup_date": F.to_date(PICKUP_TIME),
            "pickup_month": F.month(PICKUP_TIME),
            "pickup_hour": F.hour(PICKUP_TIME),
        }
    )


def pickup_hour() -> Column:
    return F.hour(PICKUP_TIME)


def tip_rate() -> Column:
    """Tip as a share of the fare.

    ``try_divide`` and not ``/``: a filter may be evaluated before the fare > 0 rule, and
    ANSI division by zero would end the query.
    """
    return F.try_divide("tip_amount", "fare_amount")


def raw_tip_rate() -> Column:
    """The ratio before any cleaning: NULL unless the fare is positive."""
    return F.when(F.col("fare_amount") > 0, tip_rate())


def airport_flag(airports: tuple[int, ...]) -> Column:
    """Two-way label: an airport at either end. One known airport end is enough."""
    touches = F.col(PICKUP_ZONE).isin(*airports) | F.col(DROPOFF_ZONE).isin(*airports)
    return F.when(touches, "Airport Trip").otherwise("Non-Airport Trip")


def airport_direction(airports: tuple[int, ...]) -> Column:
    """Four-way label by which ends are airports.

    A trip with an unknown end is Non-Airport even if the known end is an airport, because
    NULL NOT IN (...) is not true.
    """
    from_airport = F.col(PICKUP_ZONE).isin(*airports)
    to_airport = F.col(DROPOFF_ZONE).isin(*airports)
    return (
        F.when(from_airport & to_airport, "Airport-to-Airport")
        .when(from_airport & ~to_airport, "Airport Inbound")
        .when(~from_airport & to_airport, "Airport Outbound")
        .otherwise("Non-Airport")
    )

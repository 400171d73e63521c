"""Trips and zones seen through an order/line-item star schema.

Each line item is a trip: shipped = picked up, price = fare, discount = tip, quantity =
distance; nations are zones and regions boroughs. Amounts are scaled by binary fractions, so
sums are exact and do not depend on the order of addition.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcohorts.config import BASELINE, HOLIDAY, DateStudy, MonthStudy
from tripcohorts.functions.cohorts import (
    Cohorts,
    DateCohorts,
    MonthCohorts,
    all_windows,
    in_windows,
)

# The study settings that fit this data.
AIRPORTS = (1, 3, 8)
MIN_TRIPS = 10
MONTH_STUDY = MonthStudy(
    cohorts=MonthCohorts(
        months={HOLIDAY: (11, 12, 1), BASELINE: (3, 4, 9, 10)}, years=(1996, 1997, 1998), stored=False
    ),
    airports=AIRPORTS,
    boroughs=("AFRICA", "AMERICA", "ASIA", "EUROPE"),
    control_min_trips=MIN_TRIPS,
)
DATE_STUDY = DateStudy(
    cohorts=DateCohorts(
        ranges={
            BASELINE: (date(1998, 3, 1), date(1998, 3, 31)),
            HOLIDAY: (date(1998, 12, 1), date(1998, 12, 31)),
        },
        stored=False,
    ),
    airports=AIRPORTS,
    zone_min_trips=MIN_TRIPS,
)


def trips(spark: SparkSession, folder: str, cohorts: Cohorts | None = None) -> DataFrame:
    """The trips. With ``cohorts``, days outside them are already left out at the scan.

    Pickups keep their ship date's day and only gain an hour, and cohort windows are whole
    days, so the windows mean the same on the stored column and can be pushed to it. The pickup
    itself is computed, which the studies here say (``stored``).
    """
    items = spark.read.parquet(f"{folder}/lineitem.parquet")
    if cohorts is not None:
        items = items.filter(in_windows("l_shipdate", all_windows(cohorts)))
    return items.selectExpr(
        "l_shipdate + interval '1' hour * cast((l_orderkey * 7 + l_linenumber * 5) % 24 as int)"
        " as tpep_pickup_datetime",
        "(cast(rint(l_extendedprice * 100) as bigint) - 400000) * 11 / cast(1048576 as double)"
        " as fare_amount",
        "(cast(rint(l_discount * 100) as int) - 1) * l_quantity * cast(0.078125 as double)"
        " as tip_amount",
        "l_quantity * cast(0.5625 as double) - 1 as trip_distance",
        "nullif(l_partkey % 40, 39) as PULocationID",
        "nullif(l_orderkey % 41, 40) as DOLocationID",
        "case when l_linenumber <= 5 then 1L when l_linenumber = 6 then 2L end as payment_type",
    )


def zones(spark: SparkSession, folder: str) -> DataFrame:
    """Nations with their regions, as a zone lookup."""
    nation = spark.read.parquet(f"{folder}/nation.parquet")
    region = spark.read.parquet(f"{folder}/region.parquet")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        F.col("n_nationkey").cast("long").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.col("r_name").alias("service_zone"),
    )

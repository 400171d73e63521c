"""Attaching zone names to trips.

Grouped results first total the trips by zone id and join those totals: exact, because zone
names depend on the id alone, and a zone with a third of all trips is no heavier than any
other, since each task sends one row for it. Row-level results join the trips; how is left to
Spark, which knows the size of the lookup and splits hot ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcohorts.functions.features import PICKUP_ZONE
from tripcohorts.operators.cuts import SOURCES, trip_totals


def zone_dimension(
    zones: DataFrame, borough_as: str = "pickup_borough", zone_as: str = "pickup_zone"
) -> DataFrame:
    """Lookup columns under the names the trips and results use."""
    return zones.select(
        F.col("LocationID").cast("long").alias(PICKUP_ZONE),
        F.col("Borough").alias(borough_as),
        F.col("Zone").alias(zone_as),
    )


def join_zones(trips: DataFrame, dimension: DataFrame) -> DataFrame:
    """Left join on the pickup zone id: every trip stays, unmatched ones with NULL names."""
    return trips.join(dimension, PICKUP_ZONE, "left")


def zone_totals(
    trips: DataFrame, dimension: DataFrame, keys: Sequence[str], sources: Sequence[str] = SOURCES
) -> DataFrame:
    """Totals by ``keys`` and zone id, with zone names, to be grouped again."""
    return join_zones(trip_totals(trips, [*keys, PICKUP_ZONE], sources), dimension)


def repeated_zone_ids(zones: DataFrame, key: str = "LocationID") -> DataFrame:
    """Ids that occur more than once and would multiply trips in the join."""
    return zones.groupBy(key).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def with_matches(by_id: DataFrame, dimension: DataFrame) -> DataFrame:
    """Adds to counts by zone id how many rows the left join makes of each trip of that id.

    Joined counts are then products of small numbers: no trip is joined or multiplied.
    """
    matches = dimension.groupBy(PICKUP_ZONE).agg(F.count("*").alias("n_matches"))
    joined = by_id.join(matches, PICKUP_ZONE, "left")
    return joined.withColumn("n_joined", F.coalesce("n_matches", F.lit(1))).drop("n_matches")


def join_audit(trips: DataFrame, dimension: DataFrame) -> DataFrame:
    """Rows before and after the left join; equal unless an id is repeated."""
    by_id = trips.groupBy(PICKUP_ZONE).agg(F.count("*").alias("n_trips"))
    return with_matches(by_id, dimension).agg(
        F.coalesce(F.sum("n_trips"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum(F.col("n_trips") * F.col("n_joined")), F.lit(0)).alias("rows_after"),
    )

"""Named row rules: validity, usual range, extreme tips; and how often each is broken."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripcohorts.config import Thresholds
from tripcohorts.functions.features import DROPOFF_ZONE, PICKUP_ZONE, raw_tip_rate, tip_rate

Rules = dict[str, Column]


def amount_rules() -> Rules:
    return {
        "positive_fare": F.col("fare_amount") > 0,
        "non_negative_tip": F.col("tip_amount") >= 0,
        "positive_distance": F.col("trip_distance") > 0,
    }


def key_rules() -> Rules:
    return {
        "known_pickup": F.col(PICKUP_ZONE).isNotNull(),
        "known_dropoff": F.col(DROPOFF_ZONE).isNotNull(),
        "known_payment": F.col("payment_type").isNotNull(),
    }


def range_rules(limits: Thresholds) -> Rules:
    return {
        "usual_fare": F.col("fare_amount") < limits.fare_below,
        "usual_tip": F.col("tip_amount") < limits.tip_below,
        "usual_distance": F.col("trip_distance") < limits.distance_below,
        "usual_rate": tip_rate() <= limits.rate_at_most,
    }


def card_rule(card_payment: int) -> Rules:
    return {"card_payment": F.col("payment_type") == card_payment}


def all_hold(rules: Rules) -> Column:
    """One condition; NULL wherever a rule cannot be decided, which a filter drops."""
    return reduce(and_, rules.values())


def keep_valid(trips: DataFrame, rules: Rules) -> DataFrame:
    """The trips that keep every rule, with their tip rate."""
    return trips.filter(all_hold(rules)).withColumn("tip_rate", tip_rate())


def is_extreme(limits: Thresholds) -> Column:
    """A positive fare with a large tip, in money or as a share of the fare."""
    large = (F.col("tip_amount") >= limits.extreme_tip) | (raw_tip_rate() >= limits.extreme_rate)
    return (F.col("fare_amount") > 0) & large


def defects() -> Rules:
    """Conditions that are true on a defective trip; NULL amounts are no defect of these."""
    return {
        "non_positive_fare": F.col("fare_amount") <= 0,
        "negative_tip": F.col("tip_amount") < 0,
        "non_positive_distance": F.col("trip_distance") <= 0,
        "missing_pickup_location": F.col(PICKUP_ZONE).isNull(),
        "missing_dropoff_location": F.col(DROPOFF_ZONE).isNull(),
        "missing_payment_type": F.col("payment_type").isNull(),
    }


def defect_counters() -> list[Column]:
    """Row count and one counter per defect, to be aggregated in a single pass."""
    counters = [F.count_if(condition).alias(name) for name, condition in defects().items()]
    return [F.count("*").alias("total_rows"), *counters]


def count_defects(trips: DataFrame) -> DataFrame:
    return trips.agg(*defect_counters())

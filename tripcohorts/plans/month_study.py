"""Month-set study: card trips of whole years, holiday months against baseline months."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcohorts.config import MonthStudy
from tripcohorts.functions import features
from tripcohorts.functions.cohorts import select_cohorts
from tripcohorts.operators import zones as zone_ops
from tripcohorts.operators.compare import controlled_comparison as compare_strata
from tripcohorts.operators.cuts import all_cut_totals, cut_rows, trip_summary
from tripcohorts.operators.ordering import order_rows
from tripcohorts.operators.rules import amount_rules, card_rule, keep_valid, range_rules

# The cuts of this study.
CUTS = {
    "holiday_vs_baseline": ("study_period",),
    "airport_direction": ("study_period", "airport_direction"),
    "tip_rate_by_hour": ("study_period", "pickup_hour"),
    "tip_rate_by_borough": ("study_period", "borough"),
    "zone_hour_controlled_comparison": ("study_period", "borough", "pickup_hour"),
}
ORDERS = {
    "holiday_vs_baseline": ("study_period",),
    "airport_direction": ("study_period", "-trip_count", "airport_direction"),
    "tip_rate_by_hour": ("study_period", "pickup_hour"),
    "tip_rate_by_borough": ("study_period", "-avg_tip_rate", "borough"),
}


def total_row_count(trips: DataFrame) -> DataFrame:
    return trips.agg(F.count("*").alias("total_rows"))


def card_trips(trips: DataFrame, study: MonthStudy) -> DataFrame:
    """Valid, usual card trips of the cohorts. Unknown zone ids are kept."""
    rules = {**card_rule(study.card_payment), **amount_rules(), **range_rules(study.thresholds)}
    return keep_valid(
        select_cohorts(trips, features.PICKUP_TIME, study.cohorts), rules
    ).withColumns(
        {
            "pickup_hour": features.pickup_hour(),
            "airport_direction": features.airport_direction(study.airports),
        }
    )


def lookup(zones: DataFrame) -> DataFrame:
    return zone_ops.zone_dimension(zones, borough_as="borough", zone_as="zone")


def period_summary(trips: DataFrame, study: MonthStudy = MonthStudy()) -> DataFrame:
    return _plain_cut(trips, study, "holiday_vs_baseline")


def airport_direction(trips: DataFrame, study: MonthStudy = MonthStudy()) -> DataFrame:
    return _plain_cut(trips, study, "airport_direction")


def tip_rate_by_hour(trips: DataFrame, study: MonthStudy = MonthStudy()) -> DataFrame:
    return _plain_cut(trips, study, "tip_rate_by_hour")


def tip_rate_by_borough(
    trips: DataFrame, zones: DataFrame, study: MonthStudy = MonthStudy()
) -> DataFrame:
    rows = zone_ops.zone_totals(card_trips(trips, study), lookup(zones), ["study_period"])
    return _finish(rows.filter(F.col("borough").isNotNull()), "tip_rate_by_borough", totals=True)


def controlled_comparison(
    trips: DataFrame,
    zones: DataFrame,
    study: MonthStudy = MonthStudy(),
    strata: Sequence[str] = ("borough", "pickup_hour"),
) -> DataFrame:
    """Cohort difference inside each stratum; by default borough and hour, also zone."""
    rows = zone_ops.zone_totals(
        card_trips(trips, study), lookup(zones), ["study_period", "pickup_hour"], ["tip_rate"]
    )
    return _compare(rows, study, strata)


def shared_totals(trips: DataFrame, zones: DataFrame, study: MonthStudy = MonthStudy()) -> DataFrame:
    """Totals for all cuts of the study from a single scan of the trips."""
    trip_keys = ["study_period", "airport_direction", "pickup_hour"]
    rows = zone_ops.zone_totals(card_trips(trips, study), lookup(zones), trip_keys)
    return all_cut_totals(rows, CUTS)


def results_from_totals(shared: DataFrame, study: MonthStudy = MonthStudy()) -> dict[str, DataFrame]:
    """Every result table of the study, read off the shared totals."""
    results = {}
    for name in ORDERS:
        rows = cut_rows(shared, CUTS, name)
        if "borough" in CUTS[name]:
            rows = rows.filter(F.col("borough").isNotNull())
        results[name] = _finish(rows, name, totals=True)
    compared = "zone_hour_controlled_comparison"
    results[compared] = _compare(cut_rows(shared, CUTS, compared), study, ("borough", "pickup_hour"))
    return results


def _plain_cut(trips: DataFrame, study: MonthStudy, name: str) -> DataFrame:
    return _finish(card_trips(trips, study), name, totals=False)


def _finish(rows: DataFrame, name: str, totals: bool) -> DataFrame:
    return order_rows(trip_summary(rows, CUTS[name], totals=totals), *ORDERS[name])


def _compare(rows: DataFrame, study: MonthStudy, strata: Sequence[str]) -> DataFrame:
    return compare_strata(
        rows.filter(F.col("borough").isin(*study.boroughs)),
        strata,
        "study_period",
        study.control_min_trips,
        study.control_top,
        totals=True,
    )

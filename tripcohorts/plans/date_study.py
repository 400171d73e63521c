"""Date-range study: raw data quality, then cleaned trips cut six ways."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripcohorts.config import (
    PERCENTILE_ERROR,
    PERCENTILES,
    PROFILE_COLUMNS,
    TAIL_PERCENTILES,
    DateStudy,
)
from tripcohorts.functions import features
from tripcohorts.functions.cohorts import select_cohorts
from tripcohorts.operators import profile, rules
from tripcohorts.operators import zones as zone_ops
from tripcohorts.operators.cuts import (
    ALL_MEANS,
    COUNT,
    FARE,
    RATE,
    TIP,
    all_cut_totals,
    cut_rows,
    total_columns,
    trip_summary,
)
from tripcohorts.operators.ordering import order_rows
from tripcohorts.operators.percentiles import percentiles, percentiles_of, rank_check

# The cuts of this study, their measures and their order.
CUTS = {
    "all_valid_holiday_vs_normal": ("period",),
    "credit_card_holiday_vs_normal": ("period",),
    "credit_card_tip_rate_by_borough": ("period", "pickup_borough"),
    "credit_card_tip_rate_by_hour": ("period", "pickup_hour"),
    "credit_card_airport_vs_non_airport": ("period", "airport_trip_flag"),
    "credit_card_top_zones_by_tip_rate": ("period", "pickup_borough", "pickup_zone"),
}
MEANS = {
    "credit_card_tip_rate_by_borough": (TIP, RATE, FARE),
    "credit_card_tip_rate_by_hour": (TIP, RATE),
    "credit_card_top_zones_by_tip_rate": (TIP, RATE, FARE),
}
ORDERS = {
    "credit_card_tip_rate_by_borough": ("period", "-avg_tip_rate", "pickup_borough"),
    "credit_card_top_zones_by_tip_rate": ("period", "-avg_tip_rate", "pickup_borough", "pickup_zone"),
}
ALL_PAYMENTS = "all_valid_holiday_vs_normal"
TOP_ZONES = "credit_card_top_zones_by_tip_rate"
STAGES = ("raw", "study_period", "cleaned", "joined", "credit_card")


def study_trips(trips: DataFrame, study: DateStudy = DateStudy()) -> DataFrame:
    """Trips of the cohorts before any cleaning, with the raw ratio."""
    return select_cohorts(trips, features.PICKUP_TIME, study.cohorts).withColumn(
        "raw_tip_rate", features.raw_tip_rate()
    )


def clean_rules(study: DateStudy) -> rules.Rules:
    return {**rules.amount_rules(), **rules.key_rules(), **rules.range_rules(study.thresholds)}


def clean_trips(trips: DataFrame, study: DateStudy = DateStudy()) -> DataFrame:
    """Valid, usual trips of the cohorts, all payment types, with calendar and airport columns."""
    selected = select_cohorts(trips, features.PICKUP_TIME, study.cohorts)
    return features.add_calendar(rules.keep_valid(selected, clean_rules(study))).withColumn(
        "airport_trip_flag", features.airport_flag(study.airports)
    )


def card_trips(trips: DataFrame, study: DateStudy = DateStudy()) -> DataFrame:
    return clean_trips(trips, study).filter(_is_card(study))


def joined_trips(trips: DataFrame, zones: DataFrame, study: DateStudy = DateStudy()) -> DataFrame:
    """Cleaned trips with pickup borough and zone."""
    return zone_ops.join_zones(clean_trips(trips, study), zone_ops.zone_dimension(zones))


# --- data quality -------------------------------------------------------------------------


def raw_profile(trips: DataFrame, study: DateStudy = DateStudy()) -> DataFrame:
    return profile.describe(study_trips(trips, study), PROFILE_COLUMNS)


def raw_moments(trips: DataFrame, study: DateStudy = DateStudy()) -> DataFrame:
    return profile.rounded_moments(study_trips(trips, study), PROFILE_COLUMNS)


def exact_profile(trips: DataFrame, study: DateStudy = DateStudy()) -> DataFrame:
    return order_rows(profile.exact_profile(study_trips(trips, study), PROFILE_COLUMNS), "column")


def approx_percentiles(
    trips: DataFrame, study: DateStudy = DateStudy(), relative_error: float = PERCENTILE_ERROR
) -> DataFrame:
    cohort = [study.cohorts.column]
    found = percentiles(study_trips(trips, study), PROFILE_COLUMNS, PERCENTILES, relative_error, by=cohort)
    return order_rows(found, "column", "p")


def approx_percentile_ranks(
    trips: DataFrame, study: DateStudy = DateStudy(), relative_error: float = PERCENTILE_ERROR
) -> DataFrame:
    """Whether each approximate percentile has a rank within the error."""
    rows = study_trips(trips, study)
    found = percentiles(rows, PROFILE_COLUMNS, PERCENTILES, relative_error, by=[study.cohorts.column])
    return order_rows(rank_check(rows, found, PROFILE_COLUMNS, relative_error), "column", "p")


def tail_percentiles(
    trips: DataFrame, study: DateStudy = DateStudy(), relative_error: float = 0.0
) -> DataFrame:
    """Upper percentiles; exact by default, since an error as wide as the tail says nothing."""
    found = percentiles(study_trips(trips, study), PROFILE_COLUMNS, TAIL_PERCENTILES, relative_error)
    return order_rows(found, "column", "p")


def invalid_record_counts(trips: DataFrame, study: DateStudy = DateStudy()) -> DataFrame:
    return rules.count_defects(study_trips(trips, study))


def high_tip_trips_by_period(trips: DataFrame, study: DateStudy = DateStudy()) -> DataFrame:
    extreme = study_trips(trips, study).filter(rules.is_extreme(study.thresholds))
    return order_rows(profile.extreme_summary(extreme, study.cohorts.column), study.cohorts.column)


def measures(trips: DataFrame, study: DateStudy = DateStudy()) -> DataFrame:
    """One row, from one scan, that holds the profile and the approximate percentiles."""
    return profile.measures(study_trips(trips, study), PROFILE_COLUMNS)


def from_measures(measured: DataFrame) -> dict[str, DataFrame]:
    return {
        "raw_summary_statistics": profile.described(measured, PROFILE_COLUMNS),
        "approx_percentiles": order_rows(percentiles_of(measured, PROFILE_COLUMNS, PERCENTILES), "column", "p"),
    }


def study_totals(trips: DataFrame, study: DateStudy = DateStudy()) -> DataFrame:
    """Study rows by all keys of the cuts and whether they are clean, from a single scan.

    Row counts, defects and extreme tips count all rows of a group, amounts only the clean ones. Cuts,
    quality tables and funnel all follow from this small table. Counters are part of the
    grouped result, and no observed metrics, because those count rows again when the tasks of a
    lost executor are run again.
    """
    clean = rules.all_hold(clean_rules(study))
    rows = features.add_calendar(study_trips(trips, study)).withColumns(
        {
            "tip_rate": features.tip_rate(),
            "airport_trip_flag": features.airport_flag(study.airports),
            "is_clean": F.coalesce(clean, F.lit(False)),
            "is_card": _is_card(study),
        }
    )
    _, *defects = rules.defect_counters()
    return rows.groupBy(study.cohorts.column, "is_clean", *_TRIP_KEYS, features.PICKUP_ZONE).agg(
        *total_columns(only=F.col("is_clean")), *defects, *profile.extreme_totals(rules.is_extreme(study.thresholds))
    )


def quality_totals(trips: DataFrame, study: DateStudy = DateStudy()) -> DataFrame:
    """Row counts, defects and extreme tips of the study totals by cohort alone."""
    counters = [F.sum(name).alias(name) for name in (COUNT, *rules.defects())]
    return study_totals(trips, study).groupBy(study.cohorts.column).agg(*counters, *profile.merged_extremes())


def quality_from_totals(totals: DataFrame, study: DateStudy = DateStudy()) -> dict[str, DataFrame]:
    """Defect counters and extreme tips, from the study totals."""
    counters = {"total_rows": F.sum(COUNT)} | {name: F.sum(name) for name in rules.defects()}
    cohort = study.cohorts.column
    extremes = totals.groupBy(cohort).agg(*profile.merged_extremes())
    return {
        "invalid_record_counts": totals.agg(
            *[F.coalesce(total, F.lit(0)).alias(name) for name, total in counters.items()]
        ),
        "high_tip_trips_by_period": order_rows(profile.extreme_from_totals(extremes, cohort), cohort),
    }


def funnel_from_totals(
    trips: DataFrame, totals: DataFrame, zones: DataFrame, study: DateStudy = DateStudy()
) -> DataFrame:
    """Rows left after each stage, from the study totals; the raw count reads no column."""
    clean = F.when(F.col("is_clean"), F.col(COUNT)).otherwise(0)
    by_id = totals.groupBy(features.PICKUP_ZONE).agg(
        F.sum(COUNT).alias("n_study"),
        F.sum(clean).alias("n_clean"),
        F.sum(F.when(F.col("is_card"), clean).otherwise(0)).alias("n_card"),
    )
    return _funnel(trips, by_id, zones)


def row_funnel(trips: DataFrame, zones: DataFrame, study: DateStudy = DateStudy()) -> DataFrame:
    """Rows left after each stage, from one pass over the study rows.

    The raw count is its own branch: it needs no column, so Parquet answers it from file
    footers while the other branch keeps its pushed-down filters.
    """
    clean = rules.all_hold(clean_rules(study))
    by_id = (
        select_cohorts(trips, features.PICKUP_TIME, study.cohorts)
        .groupBy(features.PICKUP_ZONE)
        .agg(
            F.count("*").alias("n_study"),
            F.count_if(clean).alias("n_clean"),
            F.count_if(clean & _is_card(study)).alias("n_card"),
        )
    )
    return _funnel(trips, by_id, zones)


def _funnel(trips: DataFrame, by_id: DataFrame, zones: DataFrame) -> DataFrame:
    """Counts by zone id as rows by stage."""
    later = zone_ops.with_matches(by_id, zone_ops.zone_dimension(zones)).agg(
        _total(F.col("n_study")).alias("study_period"),
        _total(F.col("n_clean")).alias("cleaned"),
        _total(F.col("n_clean") * F.col("n_joined")).alias("joined"),
        _total(F.col("n_card") * F.col("n_joined")).alias("credit_card"),
    )
    raw = trips.agg(F.count("*").alias("raw"))
    return profile.stages_as_rows(raw, STAGES[:1]).unionByName(profile.stages_as_rows(later, STAGES[1:]))


# --- cuts of the cleaned trips ------------------------------------------------------------


def all_valid_holiday_vs_normal(trips: DataFrame, study: DateStudy = DateStudy()) -> DataFrame:
    return _finish(clean_trips(trips, study), ALL_PAYMENTS, study)


def credit_card_holiday_vs_normal(trips: DataFrame, study: DateStudy = DateStudy()) -> DataFrame:
    return _finish(card_trips(trips, study), "credit_card_holiday_vs_normal", study)


def credit_card_tip_rate_by_hour(trips: DataFrame, study: DateStudy = DateStudy()) -> DataFrame:
    return _finish(card_trips(trips, study), "credit_card_tip_rate_by_hour", study)


def credit_card_airport_vs_non_airport(trips: DataFrame, study: DateStudy = DateStudy()) -> DataFrame:
    return _finish(card_trips(trips, study), "credit_card_airport_vs_non_airport", study)


def credit_card_tip_rate_by_borough(
    trips: DataFrame, zones: DataFrame, study: DateStudy = DateStudy()
) -> DataFrame:
    """Trips whose zone id is not in the lookup form a group of their own (NULL)."""
    return _zone_cut(trips, zones, study, "credit_card_tip_rate_by_borough")


def credit_card_top_zones_by_tip_rate(
    trips: DataFrame, zones: DataFrame, study: DateStudy = DateStudy()
) -> DataFrame:
    return _zone_cut(trips, zones, study, TOP_ZONES)


# --- all cuts from one scan ---------------------------------------------------------------

_SHARED_CUTS = {
    "all": ("period",),
    **{name: ("is_card", *keys) for name, keys in CUTS.items() if name != ALL_PAYMENTS},
}


_TRIP_KEYS = ["is_card", "pickup_hour", "airport_trip_flag"]


def shared_totals(trips: DataFrame, zones: DataFrame, study: DateStudy = DateStudy()) -> DataFrame:
    """Totals for all six cuts from a single scan of the trips."""
    rows = clean_trips(trips, study).withColumn("is_card", _is_card(study))
    zoned = zone_ops.zone_totals(rows, zone_ops.zone_dimension(zones), ["period", *_TRIP_KEYS])
    return all_cut_totals(zoned, _SHARED_CUTS)


def cuts_from_totals(totals: DataFrame, zones: DataFrame) -> DataFrame:
    """The same from the study totals."""
    clean = totals.filter("is_clean")
    return all_cut_totals(zone_ops.join_zones(clean, zone_ops.zone_dimension(zones)), _SHARED_CUTS)


def results_from_totals(shared: DataFrame, study: DateStudy = DateStudy()) -> dict[str, DataFrame]:
    results = {ALL_PAYMENTS: _finish(cut_rows(shared, _SHARED_CUTS, "all"), ALL_PAYMENTS, study, True)}
    for name in CUTS:
        if name != ALL_PAYMENTS:
            rows = cut_rows(shared, _SHARED_CUTS, name).filter("is_card")
            results[name] = _finish(rows, name, study, True)
    return results


def _is_card(study: DateStudy) -> Column:
    return rules.all_hold(rules.card_rule(study.card_payment))


def _total(count: Column) -> Column:
    return F.coalesce(F.sum(count), F.lit(0))


def _zone_cut(trips: DataFrame, zones: DataFrame, study: DateStudy, name: str) -> DataFrame:
    rows = zone_ops.zone_totals(card_trips(trips, study), zone_ops.zone_dimension(zones), ["period"])
    return _finish(rows, name, study, totals=True)


def _finish(rows: DataFrame, name: str, study: DateStudy, totals: bool = False) -> DataFrame:
    table = trip_summary(rows, CUTS[name], MEANS.get(name, ALL_MEANS), totals)
    if name == TOP_ZONES:
        table = table.filter(F.col("trip_count") >= study.zone_min_trips)
    return order_rows(table, *ORDERS.get(name, CUTS[name]))

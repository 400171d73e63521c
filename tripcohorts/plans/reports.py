"""Report tables built from written results. A result not written yet is an empty table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripcohorts.config import COHORTS, REAL_BOROUGHS
from tripcohorts.operators import reports
from tripcohorts.operators.compare import cohort_delta
from tripcohorts.sources.results import read_result


def date_reports(spark: SparkSession, results: str) -> dict[str, DataFrame]:
    def table(name: str) -> DataFrame:
        return read_result(spark, f"{results}/{name}", name)

    by_period = table("credit_card_holiday_vs_normal")
    by_airport = table("credit_card_airport_vs_non_airport")
    by_hour = table("credit_card_tip_rate_by_hour")
    return {
        "cohort_delta": cohort_delta(by_period),
        "cohort_percent": reports.with_percent(by_period),
        "borough_period_pivot": reports.borough_period_pivot(table("credit_card_tip_rate_by_borough")),
        "airport_percent": reports.with_percent(by_airport),
        "airport_period_pivot": reports.airport_period_pivot(by_airport),
        "period_list": reports.distinct_sorted(by_hour, "period"),
        **{f"hour_curve {period}": reports.hour_curve(by_hour, period) for period in sorted(COHORTS)},
    }


def month_reports(spark: SparkSession, results: str) -> dict[str, DataFrame]:
    def table(name: str) -> DataFrame:
        return read_result(spark, f"{results}/{name}", name)

    return {
        "holiday_vs_baseline": table("holiday_vs_baseline"),
        "direction_without_transfers": reports.without_label(
            table("airport_direction"), "airport_direction", "Airport-to-Airport"
        ),
        "tip_rate_by_hour": table("tip_rate_by_hour"),
        "real_borough_rates": reports.only_labels(table("tip_rate_by_borough"), "borough", REAL_BOROUGHS),
        "zone_hour_controlled_comparison": table("zone_hour_controlled_comparison"),
    }

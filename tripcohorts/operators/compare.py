"""Holiday against baseline, within strata and overall."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripcohorts.config import BASELINE, COHORTS, HOLIDAY
from tripcohorts.functions.exact import exact_sum, mean, mean_of_total
from tripcohorts.operators.cuts import COUNT
from tripcohorts.operators.ordering import top_rows


def controlled_comparison(
    rows: DataFrame,
    strata: Sequence[str],
    cohort: str,
    min_trips: int,
    top: int,
    totals: bool = False,
) -> DataFrame:
    """Cohort difference of the mean tip rate inside each stratum, largest first.

    Strata need ``min_trips`` in both cohorts. Both cohorts of a stratum are aggregated side
    by side, so the trips are shuffled once (as partial sums) and not once per level.
    Differences are taken and ranked before rounding; strata break ties.
    """
    pivoted = rows.groupBy(*strata).agg(
        *_cohort_columns(cohort, HOLIDAY, "holiday", totals),
        *_cohort_columns(cohort, BASELINE, "baseline", totals),
    )
    enough = (F.col("holiday_trips") >= min_trips) & (F.col("baseline_trips") >= min_trips)
    difference = F.col("holiday_tip_rate") - F.col("baseline_tip_rate")
    ranked = top_rows(
        pivoted.filter(enough).withColumn("abs_diff", F.abs(difference)), top, "-abs_diff", *strata
    )
    return ranked.select(
        *strata,
        "holiday_trips",
        "baseline_trips",
        F.round("holiday_tip_rate", 4).alias("holiday_tip_rate"),
        F.round("baseline_tip_rate", 4).alias("baseline_tip_rate"),
        F.round(difference, 4).alias("tip_rate_difference"),
    )


def cohort_delta(summary: DataFrame, cohort: str = "period") -> DataFrame:
    """One row of headline figures from a by-cohort summary; none from an empty one."""

    def value(label: str, column: str) -> Column:
        return F.max(F.when(F.col(cohort) == label, F.col(column)))

    figures = summary.agg(
        value(HOLIDAY, "avg_tip_amount").alias("h_tip"),
        value(BASELINE, "avg_tip_amount").alias("b_tip"),
        value(HOLIDAY, "avg_tip_rate").alias("h_rate"),
        value(BASELINE, "avg_tip_rate").alias("b_rate"),
        value(HOLIDAY, COUNT).alias("holiday_trips"),
        value(BASELINE, COUNT).alias("baseline_trips"),
        F.count("*").alias("n_cohorts"),
    ).filter(F.col("n_cohorts") > 0)
    return figures.select(
        F.col("h_tip").alias("holiday_avg_tip_amount"),
        (F.col("h_tip") - F.col("b_tip")).alias("tip_amount_delta"),
        (F.col("h_rate") * 100).alias("holiday_tip_rate_pct"),
        ((F.col("h_rate") - F.col("b_rate")) * 100).alias("tip_rate_delta_pts"),
        "holiday_trips",
        "baseline_trips",
    )


def cohort_pivot(
    summary: DataFrame,
    index: str,
    cohort: str = "period",
    value: str = "avg_tip_rate_percent",
    labels: Sequence[str] = COHORTS,
) -> DataFrame:
    """index x cohort table of the mean value; rows without an index have no place in it.

    The cohorts are known, so their columns are conditional means of one aggregate, which
    spares the second shuffle of a general pivot.
    """
    columns = [F.avg(F.when(F.col(cohort) == label, F.col(value))).alias(label) for label in labels]
    return summary.filter(F.col(index).isNotNull()).groupBy(index).agg(*columns)


def _cohort_columns(cohort: str, label: str, prefix: str, totals: bool) -> list[Column]:
    mine = F.col(cohort) == label
    if totals:
        trips = F.sum(F.when(mine, F.col(COUNT)).otherwise(0))
        total, count = (F.sum(F.when(mine, F.col(f"tip_rate_{part}"))) for part in ("sum", "n"))
        rate = mean_of_total(total, count)
    else:
        trips = F.count_if(mine)
        rates = F.when(mine, F.col("tip_rate"))
        rate = mean(exact_sum(rates), F.count(rates))
    return [trips.alias(f"{prefix}_trips"), rate.alias(f"{prefix}_tip_rate")]

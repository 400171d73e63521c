"""Small reshapes of result tables for reading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcohorts.config import NO_BOROUGH_TEXT
from tripcohorts.operators.compare import cohort_pivot
from tripcohorts.operators.ordering import order_rows


def with_percent(table: DataFrame) -> DataFrame:
    return table.withColumn("avg_tip_rate_percent", F.col("avg_tip_rate") * 100)


def borough_period_pivot(borough_table: DataFrame) -> DataFrame:
    """Percent rates, borough x cohort; trips of no borough are left out, Unknown stays."""
    named = borough_table.filter(F.col("pickup_borough") != NO_BOROUGH_TEXT)
    return order_rows(cohort_pivot(with_percent(named), "pickup_borough"), "pickup_borough")


def airport_period_pivot(airport_table: DataFrame) -> DataFrame:
    return order_rows(cohort_pivot(with_percent(airport_table), "airport_trip_flag"), "airport_trip_flag")


def hour_curve(hour_table: DataFrame, period: str) -> DataFrame:
    """One cohort's percent rate by pickup hour."""
    one = with_percent(hour_table).filter(F.col("period") == period)
    return order_rows(one.select("pickup_hour", "avg_tip_rate_percent"), "pickup_hour")


def without_label(table: DataFrame, column: str, label: str) -> DataFrame:
    return table.filter(F.col(column) != label)


def only_labels(table: DataFrame, column: str, labels: Sequence[str]) -> DataFrame:
    return table.filter(F.col(column).isin(*labels))


def distinct_sorted(table: DataFrame, column: str) -> DataFrame:
    return order_rows(table.select(column).distinct(), column)

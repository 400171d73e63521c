"""Trip tables laid out by calendar month."""

from __future__ import annotations

from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcohorts.functions.cohorts import MONTH_PARTITION
from tripcohorts.functions.features import PICKUP_TIME


def write_monthly(trips: DataFrame, path: str) -> None:
    """Rewrite trips as Parquet with one folder per month.

    Spark's Parquet reader does not skip row groups on timestamps stored without a zone, so
    folders are what lets a cohort query leave the other months unread. REBALANCE sizes the
    files and splits a month that holds most of the trips over several tasks. Trips without
    a pickup time land in the default folder, and no cohort reads it. A folder that holds the
    trips themselves, or lies inside them, is refused: replacing it would destroy them.
    """
    _refuse_input(trips, path)
    month = F.year(PICKUP_TIME) * 100 + F.month(PICKUP_TIME)
    (
        trips.withColumn(MONTH_PARTITION, month)
        .hint("rebalance", F.col(MONTH_PARTITION))
        .write.mode("overwrite")
        .partitionBy(MONTH_PARTITION)
        .parquet(path)
    )


def _refuse_input(trips: DataFrame, path: str) -> None:
    target = urlparse(path).path.rstrip("/") + "/"
    for file in trips.inputFiles():
        source = unquote(urlparse(file).path)
        if source.startswith(target) or target.startswith(source.rsplit("/", 1)[0] + "/"):
            raise ValueError(f"{path} would replace the input {source}")

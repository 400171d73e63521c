"""Grouped counts and rounded means, one cut at a time or all cuts in one scan.

Means are means of per-trip values (so a tip rate is the mean of ratios, not a ratio of
sums) and are rounded after averaging.

Rows come in two forms. Plain rows are trips. *Totals* carry ``trip_count`` and, for each
measure, ``<measure>_sum`` and ``<measure>_n``; they can be grouped again without loss, so
one scan of the trips can feed many cuts. Sums are exact (see ``functions.exact``): neither the
partitioning of the trips nor the way over totals shows in a mean.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripcohorts.functions.exact import exact_sum, mean, mean_of_total, total

COUNT = "trip_count"
CUT = "cut"


class Mean(NamedTuple):
    source: str
    alias: str
    places: int


# Result names and decimal places.
TIP = Mean("tip_amount", "avg_tip_amount", 2)
RATE = Mean("tip_rate", "avg_tip_rate", 4)
FARE = Mean("fare_amount", "avg_fare_amount", 2)
DISTANCE = Mean("trip_distance", "avg_trip_distance", 2)
ALL_MEANS = (TIP, RATE, FARE, DISTANCE)
SOURCES = tuple(mean.source for mean in ALL_MEANS)


def trip_summary(
    rows: DataFrame,
    keys: Sequence[str],
    means: Sequence[Mean] = ALL_MEANS,
    totals: bool = False,
    count_as: str = COUNT,
) -> DataFrame:
    """Trip count and rounded means by any keys."""
    if totals:
        count = F.sum(COUNT)
        averages = [mean_of_total(F.sum(f"{m.source}_sum"), F.sum(f"{m.source}_n")) for m in means]
    else:
        count = F.count("*")
        averages = [mean(exact_sum(F.col(m.source)), F.count(m.source)) for m in means]
    rounded = [F.round(a, m.places).alias(m.alias) for a, m in zip(averages, means)]
    return rows.groupBy(*keys).agg(count.alias(count_as), *rounded)


def total_columns(
    sources: Sequence[str] = SOURCES, totals: bool = False, only: Column | None = None
) -> list[Column]:
    """The aggregates that turn trips, or finer totals, into totals; of trips, sums over ``only`` some of them."""
    if totals:
        names = [COUNT, *(f"{s}_{part}" for s in sources for part in ("sum", "n"))]
        return [F.sum(name).alias(name) for name in names]
    columns = [F.count("*").alias(COUNT)]
    for source in sources:
        value = F.col(source) if only is None else F.when(only, F.col(source))
        columns += [total(exact_sum(value)).alias(f"{source}_sum"), F.count(value).alias(f"{source}_n")]
    return columns


def means_of_totals(means: Sequence[Mean] = ALL_MEANS) -> list[Column]:
    """The rounded means of rows that are totals."""
    averages = [mean_of_total(F.col(f"{m.source}_sum"), F.col(f"{m.source}_n")) for m in means]
    return [F.round(a, m.places).alias(m.alias) for a, m in zip(averages, means)]


def trip_totals(rows: DataFrame, keys: Sequence[str], sources: Sequence[str] = SOURCES) -> DataFrame:
    return rows.groupBy(*keys).agg(*total_columns(sources))


def all_cut_totals(
    totals: DataFrame, cuts: Mapping[str, Sequence[str]], sources: Sequence[str] = SOURCES
) -> DataFrame:
    """Totals of several cuts out of finer totals, with the cut's name in column ``cut``.

    GROUPING SETS copy each row once for each cut, so they work on totals and never on trips.
    """
    keys = list(dict.fromkeys(key for cut in cuts.values() for key in cut))
    grouped = totals.groupingSets([[F.col(k) for k in cut] for cut in cuts.values()], *keys).agg(
        F.grouping_id().alias("_grouping"), *total_columns(sources, totals=True)
    )
    named = F.coalesce(
        *[F.when(F.col("_grouping") == _grouping_id(cut, keys), name) for name, cut in cuts.items()]
    )
    return grouped.select(named.alias(CUT), *[c for c in grouped.columns if c != "_grouping"])


def cut_rows(shared: DataFrame, cuts: Mapping[str, Sequence[str]], name: str) -> DataFrame:
    """The totals of one cut out of ``all_cut_totals``, without the other cuts' keys."""
    others = {key for cut in cuts.values() for key in cut} - set(cuts[name])
    return shared.filter(F.col(CUT) == name).drop(CUT, *others)


def _grouping_id(cut: Sequence[str], keys: Sequence[str]) -> int:
    """Spark's grouping id: one bit per key, first key highest, 1 where the key is left out."""
    return int("".join("0" if key in cut else "1" for key in keys), 2)

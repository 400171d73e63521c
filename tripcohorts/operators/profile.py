"""Data quality of the raw study rows: profile, extreme tips, stage counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripcohorts.config import PROFILE_STATISTICS
from tripcohorts.functions.exact import exact_sum, mean, merged_sum, rounded_mean
from tripcohorts.operators.cuts import Mean, trip_summary
from tripcohorts.operators.percentiles import exact_percentiles, quantiles, sketch_size

# Result names and decimal places of the extreme-tip summary, the error of the
# profile's quartiles.
EXTREME_COUNT = "high_tip_trip_count"
EXTREME_MEANS = (
    Mean("tip_amount", "avg_high_tip_amount", 2),
    Mean("raw_tip_rate", "avg_high_tip_rate", 4),
    Mean("fare_amount", "avg_fare_amount", 2),
    Mean("trip_distance", "avg_trip_distance", 2),
)
QUARTILE_ERROR = 0.001


def moments(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample deviation, min and max; one row per column, one scan."""
    makers = {"count": F.count, "mean": lambda c: mean(exact_sum(F.col(c)), F.count(c)), "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    wide = frame.agg(*[make(c).alias(f"{c}__{s}") for c in columns for s, make in makers.items()])
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{s}").alias(s) for s in makers])
        for c in columns
    ]
    return wide.select(F.inline(F.array(*rows)))


def rounded_moments(frame: DataFrame, columns: Sequence[str], places: int = 4) -> DataFrame:
    table = moments(frame, columns)
    return table.withColumns({s: F.round(s, places) for s in ("mean", "stddev")})


def exact_profile(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rounded moments and exact quartiles, one typed row per column."""
    shares = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    found = exact_percentiles(frame, columns, list(shares.values()))
    quartiles = found.groupBy("column").agg(
        *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(name) for name, p in shares.items()]
    )
    return rounded_moments(frame, columns).join(quartiles, "column")


def describe(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Statistics as rows, columns as columns, all text; quartiles are approximate.

    The table ``DataFrame.summary`` gives, from one scan of one aggregate: moments and KLL sketches.
    """
    return described(measures(frame, columns), columns)


def measures(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the moments of each column, and under its name a sketch that also gives other percentiles."""
    makers = {"count": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    aggregates = []
    for c in columns:
        value = F.col(c).cast("double")
        aggregates.append(F.kll_sketch_agg_double(value, sketch_size(QUARTILE_ERROR)).alias(c))
        aggregates += [make(value).alias(f"{c}__{s}") for s, make in makers.items()]
    return frame.agg(*aggregates)


def described(measured: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Measures as the table of ``describe``."""
    shares = {s: float(s.rstrip("%")) / 100 for s in PROFILE_STATISTICS if s.endswith("%")}
    found = {f"{c}__quartiles": quantiles(F.col(c), list(shares.values())) for c in columns}
    rows = []
    for place, s in enumerate(PROFILE_STATISTICS):
        texts = [F.get(f"{c}__quartiles", F.lit(list(shares).index(s))) if s in shares else F.col(f"{c}__{s}") for c in columns]
        named = [text.cast("string").alias(c) for text, c in zip(texts, columns, strict=True)]
        rows.append(F.struct(F.lit(place).alias("place"), F.lit(s).alias("summary"), *named))
    return measured.withColumns(found).select(F.inline(F.array(*rows))).orderBy("place").drop("place")


def extreme_summary(extreme_trips: DataFrame, cohort: str) -> DataFrame:
    return trip_summary(extreme_trips, [cohort], EXTREME_MEANS, count_as=EXTREME_COUNT)


def extreme_totals(extreme: Column) -> list[Column]:
    """The extreme summary's sums and counts over rows that also hold other trips."""
    columns = [F.count_if(extreme).alias(EXTREME_COUNT)]
    for m in EXTREME_MEANS:
        value = F.when(extreme, F.col(m.source))
        name = f"extreme_{m.source}"
        columns += [exact_sum(value).alias(f"{name}_sum"), F.count(value).alias(f"{name}_n")]
    return columns


def merged_extremes() -> list[Column]:
    """The aggregates that turn finer extreme totals into coarser ones."""
    columns = [F.sum(EXTREME_COUNT).alias(EXTREME_COUNT)]
    for m in EXTREME_MEANS:
        name = f"extreme_{m.source}"
        columns += [merged_sum(F.col(f"{name}_sum")).alias(f"{name}_sum"), F.sum(f"{name}_n").alias(f"{name}_n")]
    return columns


def extreme_from_totals(totals: DataFrame, cohort: str) -> DataFrame:
    means = [
        rounded_mean(F.col(f"extreme_{m.source}_sum"), F.col(f"extreme_{m.source}_n"), m.places).alias(m.alias)
        for m in EXTREME_MEANS
    ]
    return totals.filter(F.col(EXTREME_COUNT) > 0).select(cohort, EXTREME_COUNT, *means)


def stages_as_rows(wide: DataFrame, stages: Sequence[str]) -> DataFrame:
    """One-row counters turned into (stage, n_rows) rows in the given order."""
    rows = F.array(
        *[F.struct(F.lit(s).alias("stage"), F.col(s).cast("long").alias("n_rows")) for s in stages]
    )
    return wide.select(F.inline(rows))

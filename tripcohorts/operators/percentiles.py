"""Percentiles of several columns at once, approximate or exact.

Approximate ones are read off KLL sketches, made by cohort and merged; nothing runs until the result is
asked for. Exact ones select by digits: a scan counts the rows of each bucket of a key that
rises with the value, the bucket that holds the wanted rank is counted again by a finer key, and so on,
four scans at most. What is shuffled is counts of buckets, never rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Smallest and largest size of a KLL sketch.
LEAST_SKETCH, LARGEST_SKETCH = 8, 65_535

#: Buckets between two powers of two in the first scan, buckets of the scans after.
OCTAVE, FINER = 64, 1 << 20

#: Keys of NaN, which Spark puts last, of what is infinite, and of the smallest positive number.
NOT_A_NUMBER, INFINITE, SMALLEST = 1_000_000, 900_000, 1100 * OCTAVE


def sketch_size(relative_error: float) -> int:
    """The size whose ranks are right within half of the error, in 99 of 100 sketches; the whole error is far rarer."""
    size = ceil((2.296 / (relative_error / 2)) ** (1 / 0.9723))
    return min(max(size, LEAST_SKETCH), LARGEST_SKETCH)


def sketches(frame: DataFrame, columns: Sequence[str], relative_error: float, by: Sequence[str] = ()) -> DataFrame:
    """A KLL sketch of each column by the keys; rows that can be kept and merged with those of other trips."""
    size = sketch_size(relative_error)
    return frame.groupBy(*by).agg(*[F.kll_sketch_agg_double(F.col(c).cast("double"), size).alias(c) for c in columns])


def merged(found: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Sketches by fewer keys."""
    return found.groupBy(*by).agg(*[F.kll_merge_agg_double(c).alias(c) for c in columns])


def quantiles(sketch: Column, ps: Sequence[float]) -> Column:
    """The values at some shares, NULL for a sketch without values."""
    shares = F.array(*[F.lit(float(p)) for p in ps])
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, shares))


def approx_percentiles(
    frame: DataFrame, columns: Sequence[str], ps: Sequence[float], relative_error: float, by: Sequence[str] = ()
) -> DataFrame:
    """Rows (column, p, value); the value's rank is within ``relative_error`` of p. NaN is left out.

    Sketches are made by the keys and merged. An upper-tail percentile needs an error well below
    1 - p, or the maximum is a valid answer.
    """
    found = sketches(frame, columns, relative_error, by)
    return percentiles_of(merged(found, columns) if by else found, columns, ps)


def percentiles_of(found: DataFrame, columns: Sequence[str], ps: Sequence[float]) -> DataFrame:
    """Rows (column, p, value) of one row of sketches."""
    each = [
        F.struct(F.lit(c).alias("column"), F.lit(float(p)).alias("p"), F.get(quantiles(F.col(c), ps), F.lit(i)).alias("value"))
        for c in columns
        for i, p in enumerate(ps)
    ]
    return found.select(F.inline(F.array(*each)))


@dataclass(frozen=True)
class Bucket:
    """Values from low to high, and the wanted rank among them."""

    low: float
    high: float
    rank: int

    @property
    def is_open(self) -> bool:
        """Whether it holds different values; not so for NaN."""
        return self.low < self.high


Wanted = dict[tuple[str, float], Bucket]


def exact_percentiles(frame: DataFrame, columns: Sequence[str], ps: Sequence[float]) -> DataFrame:
    """Rows (column, p, value): the smallest value at or above a share p of the non-NULL rows.

    NaN counts as the greatest value. A scan narrows the buckets of all columns and shares together,
    and goes over the rows only where some bucket still holds different values.
    """
    rows = frame.select(*[F.col(c).cast("double").alias(c) for c in columns])
    every = {c: F.struct(F.lit(0).alias("target"), _rising_key(F.col(c)).alias("key")) for c in columns}
    wanted = _narrowed(rows, every, [(c, 0, float(p), None) for c in columns for p in ps])
    for finer in (_finer_key, _finer_key, lambda value, bucket: value):
        open_ones = {key: bucket for key, bucket in wanted.items() if bucket.is_open}
        if not open_ones:
            break
        keyed, asked = {}, []
        for column in dict.fromkeys(c for c, _ in open_ones):
            spans = sorted({(b.low, b.high) for (c, _), b in open_ones.items() if c == column})
            value = F.col(column)
            each = [
                F.when(value.between(*span), F.struct(F.lit(i).alias("target"), finer(value, span).alias("key")))
                for i, span in enumerate(spans)
            ]
            keyed[column] = F.coalesce(*each)
            asked += [(c, spans.index((b.low, b.high)), p, b.rank) for (c, p), b in open_ones.items() if c == column]
        wanted |= _narrowed(rows, keyed, asked)
    found = [(c, float(p), wanted[c, p].low if (c, p) in wanted else None) for c in columns for p in map(float, ps)]
    return frame.sparkSession.createDataFrame(found, "column string, p double, value double")


def _rising_key(value: Column) -> Column:
    """A number that rises with the value; values with the same one differ by about a hundredth."""
    size = F.floor(F.log2(F.abs(value)) * OCTAVE) + SMALLEST  # the logarithm never falls
    key = F.when(F.isnan(value), F.lit(NOT_A_NUMBER)).when(F.abs(value) == float("inf"), F.signum(value) * INFINITE)
    return key.when(value == 0, F.lit(0)).when(value.isNotNull(), F.signum(value) * size).cast("double")


def _finer_key(value: Column, span: tuple[float, float]) -> Column:
    low, high = span
    return F.floor((value - low) / (high - low) * FINER).cast("double")


def _narrowed(rows: DataFrame, keyed: dict[str, Column], asked: list[tuple[str, int, float, int | None]]) -> Wanted:
    """The bucket of each asked (column, target, p, rank): one scan, whose counts of keys are shuffled.

    Without a rank it follows from p and the number of values. ``keyed`` has a struct of target and key, or NULL,
    for each column.
    """
    each = [
        F.struct(
            F.lit(c).alias("column"), both["target"].alias("target"), both["key"].alias("key"), F.col(c).alias("value")
        )
        for c, both in keyed.items()
    ]
    counted = rows.select(F.inline(F.array(*each))).filter("key is not null").groupBy("column", "target", "key")
    counted = counted.agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    target = Window.partitionBy("column", "target")
    counted = counted.withColumns({"upto": F.sum("n").over(target.orderBy("key")), "total": F.sum("n").over(target)})
    ranks = rows.sparkSession.createDataFrame(asked, "column string, target int, p double, rank long")
    by_share = F.greatest(F.lit(1), F.ceil(F.col("total") * F.col("p")))
    reached = counted.join(F.broadcast(ranks), ["column", "target"]).withColumn("rank", F.coalesce("rank", by_share))
    found = reached.filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))
    # a row for each asked share
    return {
        (r["column"], r["p"]): Bucket(r["low"], r["high"], r["rank"] - (r["upto"] - r["n"])) for r in found.collect()
    }


def percentiles(
    frame: DataFrame, columns: Sequence[str], ps: Sequence[float], relative_error: float = 0.0, by: Sequence[str] = ()
) -> DataFrame:
    """Exact percentiles for error 0, approximate ones otherwise, from sketches by some keys."""
    if relative_error == 0:
        return exact_percentiles(frame, columns, ps)
    return approx_percentiles(frame, columns, ps, relative_error, by)


def rank_check(frame: DataFrame, found: DataFrame, columns: Sequence[str], relative_error: float) -> DataFrame:
    """column, p, and whether the rank of each found value is within the error of p, give or take a row.

    Rows are counted by how many of their column's found values lie above them, and how many at
    or above; these few counts are all that is shuffled. Nothing runs before the result is asked for, and a column
    without values has no rows.
    """
    values = found.groupBy("column").agg(F.collect_list(F.struct("p", "value")).alias("found"))
    each = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("row")) for c in columns]
    rows = frame.select(F.inline(F.array(*each))).filter("row is not null")
    met = rows.join(F.broadcast(values), "column")
    above = met.groupBy(
        "column",
        F.transform("found", lambda f: f["value"] > F.col("row")).alias("above"),
        F.transform("found", lambda f: f["value"] >= F.col("row")).alias("reached"),
    ).agg(F.count("*").alias("n"), F.any_value("found").alias("found"))
    each_found = above.select("column", "n", F.inline(F.arrays_zip("found", "above", "reached")))
    summed = each_found.groupBy("column", F.col("found.p").alias("p")).agg(
        F.sum("n").alias("total"),
        F.sum(F.when(F.col("above"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("reached"), F.col("n")).otherwise(0)).alias("upto"),
    )
    near = (F.col("below") <= F.col("total") * (F.col("p") + relative_error) + 1) & (
        F.col("upto") >= F.col("total") * (F.col("p") - relative_error) - 1
    )
    return summed.select("column", "p", near.alias("within_error"))

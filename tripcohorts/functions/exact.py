"""Sums and means that do not depend on the order of the rows.

Adding doubles rounds after every step, so another partitioning gives another sum, and a mean next to
a rounding boundary another result. Here a value is taken apart into two whole numbers, which add up
without rounding: units of a ten-thousandth, and what is left over in steps of 2 ** -36. Amounts in
cents are units only, so their sums are exact; other values keep 11 decimals. The two sums
make one decimal in the end, and decimals can be summed again. A long holds the sums of 9e12 values up to
100, and fails beyond. Values of 2 ** 40 and more, infinite ones and NaN have no place in a decimal; where they
are let in they are added as doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS, STEP_BITS = 10_000, 36

#: Type of a sum as one number: 18 digits before and after the point.
NUMBER = "decimal(36,18)"

#: Decimals of a mean that are right, and that its rounding goes by.
PLACES = 10


def exact_sum(value: Column) -> Column:
    """Aggregate: the sum of a numeric column as a struct; fields are NULL without values."""
    value = value.cast("double")
    common = F.abs(value) < float(1 << 40)  # not true for NaN, which Spark puts above all numbers
    held = F.when(common, value).when(value.isNotNull(), 0.0)
    units = F.rint(held * UNITS)
    rest = F.rint((held - units / UNITS) * float(1 << STEP_BITS))
    sums = {"units": units.cast("long"), "rest": rest.cast("long"), "beyond": F.when(~common, value)}
    return F.struct(*[F.sum(part).alias(name) for name, part in sums.items()])


def merged_sum(sums: Column) -> Column:
    """Aggregate: the sum of exact sums."""
    return F.struct(*[F.sum(sums.getField(name)).alias(name) for name in ("units", "rest", "beyond")])


def mean(sums: Column, count: Column) -> Column:
    """The mean of an exact sum as a double, to PLACES decimals; whole numbers go in, so it is the same in any order."""
    by = count.cast("double")
    parts = F.try_divide(sums.getField("units"), by * UNITS) + F.try_divide(sums.getField("rest"), by * float(1 << STEP_BITS))
    return F.round(parts + F.coalesce(F.try_divide(sums.getField("beyond"), by), F.lit(0.0)), PLACES)


def rounded_mean(sums: Column, count: Column, places: int) -> Column:
    """The mean rounded half up on its decimal digits."""
    return F.round(mean(sums, count), places)


def mean_of_total(total: Column, count: Column) -> Column:
    """The mean of a decimal sum as a double, to PLACES decimals; NULL without values."""
    return F.round(F.try_divide(total, count.cast("decimal(20,0)")), PLACES).cast("double")


def total(sums: Column) -> Column:
    """An exact sum as a decimal, to be summed again; fails if it holds values beyond."""
    refused = F.raise_error(F.lit("infinite, undefined or huge amounts have no total"))
    return F.when(sums.getField("beyond").isNull(), _number(sums)).otherwise(refused.cast(NUMBER))


def _number(sums: Column) -> Column:
    """Both parts as one decimal; whole steps go up first, so that their fraction keeps all its digits."""
    units, rest = sums.getField("units"), sums.getField("rest")
    fraction = rest.bitwiseAND(F.lit((1 << STEP_BITS) - 1).cast("long")) * F.lit(2.0**-STEP_BITS)
    tenthousandths = units.cast("decimal(19,0)") * F.lit(f"{1 / UNITS:.4f}").cast("decimal(4,4)")
    return (tenthousandths.cast(NUMBER) + F.shiftright(rest, STEP_BITS).cast(NUMBER) + fraction.cast(NUMBER)).cast(NUMBER)


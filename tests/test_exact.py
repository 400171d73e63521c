"""Sums that do not depend on the order of the rows."""

from __future__ import annotations

import math
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from helpers import values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as registered
from tripcohorts.functions import exact
from tripcohorts.operators.cuts import Mean, trip_summary, trip_totals

amounts = st.one_of(
    st.integers(-(10**7), 10**7).map(lambda c: c / 100),
    st.floats(-1e6, 1e6).map(lambda x: x if abs(x) > 1e-4 else 0.0),
    st.integers(-(2**30), 2**30).map(lambda i: i / 1048576),
    st.none(),
)


def means(frame, *more):
    sums, count = exact.exact_sum(F.col("x")), F.count("x")
    return frame.groupBy(*more).agg(exact.mean(sums, count).alias("mean"), exact.rounded_mean(sums, count, 2).alias("rounded"))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(groups=st.lists(st.lists(amounts, max_size=30), min_size=1, max_size=8))
def test_means_are_those_of_fractions(spark, groups):
    rows = [(g, x) for g, xs in enumerate(groups) for x in xs] + [(-1, None)]
    found = {r["g"]: r for r in means(spark.createDataFrame(rows, "g int, x double"), "g").collect()}
    assert found[-1]["mean"] is None and found[-1]["rounded"] is None
    for g, xs in enumerate(groups):
        known = [x for x in xs if x is not None]
        if known:
            wanted = sum(Fraction(str(x)) if round(x * 100) / 100 == x else Fraction(x) for x in known) / len(known)
            assert abs(Fraction(found[g]["mean"]) - wanted) <= Fraction(1, 10**10) + abs(wanted) * Fraction(1, 2**53)
            held = (Decimal(wanted.numerator) / Decimal(wanted.denominator)).quantize(Decimal(1).scaleb(-10), ROUND_HALF_UP)
            near_half = min(abs(held * 1000 % 10 - 5), 5) < Decimal("1e-6")
            half_up = held.quantize(Decimal("0.01"), ROUND_HALF_UP)
            assert found[g]["rounded"] == float(half_up) or near_half and any(x * 100 % 1 for x in known)


def test_a_mean_on_a_rounding_boundary(spark):
    """1.005 as a double lies below the boundary, and a sum of doubles on either side of it."""
    frame = spark.createDataFrame([(1.0,), (1.01,)] * 500 + [(0.1,)] * 30 + [(0.2,)] * 30, "x double")
    assert means(frame.filter("x >= 1")).first()["rounded"] == 1.01
    frame = spark.createDataFrame([(0.125,)] * 7 + [(-0.125,)] * 3 + [(0.725,)], "x double")
    assert means(frame.filter("x < 0.7 and x > 0")).first()["rounded"] == 0.13
    assert means(frame.filter("x < 0")).first()["rounded"] == -0.13


def test_no_partitioning_shows(spark):
    rows = spark.range(20_000).select((F.rand(3) * F.pow(F.lit(10.0), F.col("id") % 8) - 5).alias("x"), (F.col("id") % 3).alias("g"))
    rows = spark.createDataFrame(rows.collect())
    seen, plain = set(), set()
    for parts in (1, 3, 17, 64):
        for seed in (1, 2):
            dealt = rows.orderBy(F.rand(seed)).repartition(parts)
            seen.add(tuple(sorted(values(means(dealt, "g")))))
            plain.add(dealt.agg(F.avg("x")).first()[0])
    assert len(seen) == 1 and len(plain) > 1


def test_the_way_over_totals_does_not_show(spark):
    rows = spark.range(5000).select((F.sin("id") * 40).alias("x"), (F.col("id") % 7).alias("a"), (F.col("id") % 3).alias("b"))
    keys = ["a", "b"]
    fine = trip_totals(rows, keys, ["x"])
    over_totals = trip_summary(fine, ["b"], (Mean("x", "m", 10),), totals=True)
    assert sorted(values(over_totals)) == sorted(values(trip_summary(rows, ["b"], (Mean("x", "m", 10),))))
    with pytest.raises(Exception, match="no total"):
        trip_totals(rows.withColumn("x", F.lit(float("nan"))), keys, ["x"]).collect()


@pytest.mark.parametrize("odd", [float("nan"), float("inf"), -float("inf"), 1e300, float(2**41)])
def test_values_beyond_are_added_as_doubles(spark, odd):
    found = means(spark.createDataFrame([(odd,), (1.5,), (None,)], "x double")).first()["mean"]
    wanted = (odd + 1.5) / 2
    assert math.isnan(found) if math.isnan(wanted) else found == wanted


def test_integers_and_decimals(spark):
    frame = spark.range(1, 5).select(F.col("id").alias("x"), F.col("id").cast("decimal(10,2)").alias("d"))
    assert means(frame).first()["mean"] == 2.5
    assert values(trip_summary(frame, [], (Mean("d", "m", 1),))) == [(4, 2.5)]


def test_prices_are_the_same_however_they_are_dealt(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    wanted = values(registered.queries()["raw_price_means"](spark, folder))
    spark.read.parquet(f"{folder}/lineitem.parquet").orderBy(F.rand(5)).repartition(13).write.parquet(str(tmp_path / "lineitem.parquet"))
    assert values(registered.queries()["raw_price_means"](spark, str(tmp_path))) == wanted

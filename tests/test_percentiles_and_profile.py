from __future__ import annotations

from math import ceil

import pytest
from helpers import trip, trips, values
from pyspark.sql import functions as F

from tripcohorts.config import PERCENTILES, PROFILE_COLUMNS, TAIL_PERCENTILES
from tripcohorts.operators import percentiles as P
from tripcohorts.operators import profile
from tripcohorts.plans import date_study

PS = sorted({*PERCENTILES, *TAIL_PERCENTILES, 0.0, 1.0})


def sample(spark, n=20000, parts=11):
    """A long-tailed column, one with a third of its rows equal, one half unknown, one unknown."""
    i = F.col("id")
    return spark.range(0, n, 1, parts).select(
        (F.pmod(i * 7919, F.lit(n)) / 100 + F.when(i % 500 == 0, i).otherwise(0)).alias("tail"),
        F.when(i % 3 == 0, 5.0).otherwise(F.pmod(i * 31, F.lit(97)).cast("double")).alias("hot"),
        F.when(i % 2 == 0, F.pmod(i * 104729, F.lit(1009)) / 7).alias("half"),
        F.lit(None).cast("double").alias("none"),
    )


@pytest.fixture(scope="module")
def table(spark):
    return sample(spark).cache()


@pytest.fixture(scope="module")
def sorted_columns(table):
    rows = table.collect()
    return {c: sorted(r[c] for r in rows if r[c] is not None) for c in table.columns}


def as_dict(frame):
    return {(c, p): v for c, p, v in frame.select("column", "p", "value").collect()}


def test_exact_percentiles_are_the_ranked_values(table, sorted_columns):
    found = as_dict(P.exact_percentiles(table, table.columns, PS))
    assert len(found) == len(PS) * 4
    for column, ranked in sorted_columns.items():
        for p in PS:
            expected = ranked[max(ceil(len(ranked) * p), 1) - 1] if ranked else None
            assert found[column, p] == expected, (column, p)


def test_exact_percentiles_agree_with_the_builtin(table):
    found = as_dict(P.exact_percentiles(table, ["tail", "hot", "half"], TAIL_PERCENTILES))
    for (column, p), value in found.items():
        builtin = table.agg(F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {column})")).first()[0]
        assert value == builtin


@pytest.mark.parametrize("error", [0.05, 0.01, 0.001])
def test_approximate_ranks_are_within_the_error(table, sorted_columns, error):
    found = as_dict(P.approx_percentiles(table, table.columns, PS, error))
    for column, ranked in sorted_columns.items():
        n = len(ranked)
        for p in PS:
            value = found[column, p]
            if not ranked:
                assert value is None
                continue
            lowest = sum(v < value for v in ranked) + 1
            highest = sum(v <= value for v in ranked)
            assert lowest - 1 <= (p + error) * n and highest >= (p - error) * n, (column, p, value)


def test_error_zero_means_exact(table, sorted_columns):
    found = as_dict(P.percentiles(table, ["tail"], [0.9999], 0.0))
    assert found["tail", 0.9999] == sorted_columns["tail"][ceil(20000 * 0.9999) - 1]
    assert len(as_dict(P.percentiles(table, ["tail"], [0.5, 0.9], 0.01))) == 2


def test_no_rows(spark):
    empty = sample(spark).limit(0)
    assert set(as_dict(P.exact_percentiles(empty, ["tail", "hot"], [0.5])).values()) == {None}
    assert set(as_dict(P.approx_percentiles(empty, ["tail", "hot"], [0.5], 0.01)).values()) == {None}


def scans(table, monkeypatch, work):
    """The result of some work, and the keys of each of its scans."""
    seen = []
    plain = P._narrowed
    monkeypatch.setattr(P, "_narrowed", lambda rows, keyed, asked: seen.append(keyed) or plain(rows, keyed, asked))
    return work(), seen


def test_exact_percentiles_take_four_scans_at_most(table, sorted_columns, monkeypatch):
    """With few buckets in each scan, the last one has to tell all values of a bucket apart."""
    monkeypatch.setattr(P, "FINER", 3)
    monkeypatch.setattr(P, "OCTAVE", 1)
    found, seen = scans(table, monkeypatch, lambda: as_dict(P.exact_percentiles(table, table.columns, PS)))
    assert len(seen) == 4 and "none" not in seen[1]
    for column, ranked in sorted_columns.items():
        for p in PS:
            assert found[column, p] == (ranked[max(ceil(len(ranked) * p), 1) - 1] if ranked else None), (column, p)


def test_settled_columns_are_not_read_again(table, monkeypatch):
    _, seen = scans(table, monkeypatch, lambda: P.exact_percentiles(table, ["hot", "tail"], [0.1, 0.9]).collect())
    assert [sorted(keyed) for keyed in seen[:2]] == [["hot", "tail"], ["tail"]] and len(seen) <= 3


ODD = [float("nan"), float("inf"), -float("inf"), 0.0, -0.0, 5e-324, -5e-324, 1.7976931348623157e308, -1.7976931348623157e308, 2.2250738585072014e-308]


@pytest.mark.parametrize("shares", [(300, 700, 0), (1, 0, 99), (0, 50, 950)])
def test_odd_values_have_their_ranks(spark, shares):
    """NaN last, one value in most rows, infinities, the smallest and largest numbers, neighbours."""
    nan, spread, equal = shares
    values_ = [float("nan")] * nan + [4.25] * equal + ODD + [1 + i * 2.0**-52 for i in range(spread)]
    frame = spark.createDataFrame([(v,) for v in values_] + [(None,)] * 5, "x double").repartition(5)
    ranked = sorted(values_, key=lambda v: (v != v, v))
    found = as_dict(P.exact_percentiles(frame, ["x"], [0.0, 0.001, 0.25, 0.5, 0.69, 0.7, 0.71, 0.9, 0.999, 1.0]))
    for (_, p), value in found.items():
        wanted = ranked[max(ceil(len(ranked) * p), 1) - 1]
        assert value == wanted or value != value and wanted != wanted, p


def test_the_first_key_rises_with_the_value(spark):
    steps = [s * m * 2.0**e for s in (-1, 1) for e in range(-1074, 1023, 7) for m in (1, 1.0000001, 1.999999999)]
    frame = spark.createDataFrame([(float(v),) for v in sorted({*steps, *ODD} - {0.0}, key=lambda v: (v != v, v))], "x double")
    keys = [r[0] for r in frame.coalesce(1).select(P._rising_key(F.col("x"))).collect()]
    assert keys == sorted(keys) and len(set(keys)) > 500


def test_approximate_percentiles_run_when_they_are_asked_for(spark, table):
    group = "nothing runs"
    spark.sparkContext.setJobGroup(group, group)
    found = P.approx_percentiles(table, ["tail"], [0.5], 0.01, by=["hot"])
    checked = P.rank_check(table, found, ["tail"], 0.01)
    profile.describe(table, ["tail"])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    assert values(checked) == [("tail", 0.5, True)]
    assert "spark_partition_id" not in str(found._jdf.queryExecution().toString()).lower()


def test_sketches_are_kept_by_cohort_and_merged_later(table, sorted_columns):
    kept = P.sketches(table, ["tail", "none"], 0.01, by=["hot"])
    assert kept.count() > 50
    both = P.merged(kept, ["tail", "none"]).select(P.quantiles(F.col("tail"), [0.9]).alias("t"), P.quantiles(F.col("none"), [0.9]).alias("n")).first()
    rank = sum(v <= both["t"][0] for v in sorted_columns["tail"]) / 20000
    assert abs(rank - 0.9) < 0.01 and both["n"] is None


def test_the_rank_check_fails_for_a_wrong_value(spark, table):
    found = P.approx_percentiles(table, ["tail", "half"], [0.5, 0.9], 0.01)
    assert all(r["within_error"] for r in P.rank_check(table, found, ["tail", "half"], 0.01).collect())
    off = found.withColumn("value", F.col("value") * 1.1)
    assert not any(r["within_error"] for r in P.rank_check(table, off, ["tail", "half"], 0.01).collect())


def study_rows(spark):
    fares = [4.0, 8.0, 16.0, 0.0, -2.0]
    return trips(spark, [trip(fare_amount=f, tip_amount=i / 4, trip_distance=float(i)) for i, f in enumerate(fares)])


def test_profile_has_the_shape_and_values_of_summary(spark):
    rows = date_study.study_trips(study_rows(spark))
    ours = date_study.raw_profile(study_rows(spark))
    builtin = rows.select(*PROFILE_COLUMNS).summary(*ours.select("summary").toPandas()["summary"])
    assert ours.columns == ["summary", *PROFILE_COLUMNS]
    for a, b in zip(values(ours), values(builtin), strict=True):
        assert a[0] == b[0] and [pytest.approx(float(x)) for x in a[1:]] == [float(x) for x in b[1:]]


def test_profile_reads_the_trips_once(spark, table):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    ours = profile.describe(table.mapInArrow(counted, table.schema), ["tail", "hot", "half"]).collect()
    assert seen.value == 20000
    wanted = table.select("tail", "hot", "half").summary("mean", "stddev", "50%").collect()
    rows = {r["summary"]: r for r in ours}
    for row in wanted:
        for c in ("tail", "hot", "half"):
            assert float(rows[row["summary"]][c]) == pytest.approx(float(row[c]), rel=0.005)


def test_profile_counts_only_known_ratios(spark):
    table = {r["summary"]: r for r in date_study.raw_profile(study_rows(spark)).collect()}
    assert table["count"]["fare_amount"] == "5" and table["count"]["raw_tip_rate"] == "3"


def test_moments(spark):
    frame = spark.createDataFrame([(1.0,), (2.0,), (None,), (6.0,)], "x double")
    assert values(profile.rounded_moments(frame, ["x"])) == [("x", 3, 3.0, 2.6458, 1.0, 6.0)]


def test_profile_of_no_rows(spark):
    table = {r["summary"]: r for r in date_study.raw_profile(trips(spark, [])).collect()}
    assert table["count"]["fare_amount"] == "0" and table["mean"]["fare_amount"] is None

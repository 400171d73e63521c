"""Every registered query against DuckDB on the smallest driver tables."""

from __future__ import annotations

import os

import pytest
from oracle_check import ORACLE, connect, differences, registered

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = connect(FOLDER)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_duckdb(spark, duck, name):
    assert differences(spark, duck, name, FOLDER) is None


def test_every_oracle_has_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_only_approximate_results_have_no_oracle():
    optional = {} if registered.llm is None else {*registered.llm.queries(), "pipeline"}
    missing = set(registered.queries()) - set(ORACLE) - set(optional)
    assert missing == {"raw_profile", "approx_percentiles"}


def test_scans_of_cohort_queries_compare_timestamps(spark):
    plan = registered.queries()["period_summary"](spark, FOLDER)._jdf.queryExecution().toString()
    scan = plan[plan.rindex("FileScan") :].splitlines()[0]
    assert "PushedFilters" in scan and "year(" not in scan and "month(" not in scan


def test_entry_is_the_controlled_comparison(spark):
    rows = registered.entry(spark)
    assert rows.columns[:4] == ["borough", "pickup_hour", "holiday_trips", "baseline_trips"]
    assert rows.count() == 20

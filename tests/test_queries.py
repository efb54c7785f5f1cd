"""Registered queries: equal to their SQL, and planned as they should be."""

import pytest

import __spark_entry__ as entry
from delaykit.catalogue import queries as catalogue
from delaykit.catalogue.registry import ORACLES, QUERIES
from delaykit.plans.features import extract_features
from tests.compare import connect, differences
from tests.conftest import SMALL

# The text queries have tests of their own.
assert set(QUERIES) <= set(entry.queries()) and ORACLES.items() <= entry.oracle_sql().items()
# Results of a model or a sample, which SQL cannot state.
ROWS_ONLY = {"sampled_flights", "hash_sampled_requests", "forest_accuracy", "forest_distribution", "forest_predictions"}


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY and set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.schema == entry.entry(spark).schema


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SMALL), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_report_makes_the_features_once(spark, monkeypatch):
    made = []
    monkeypatch.setattr(catalogue, "_FORESTS", {})
    monkeypatch.setattr(catalogue, "_STORED", {})
    monkeypatch.setattr(catalogue, "extract_features", lambda rows: made.append(rows) or extract_features(rows))
    assert QUERIES["forest_report"](spark, SMALL).first().beats_largest_class
    assert len(made) == 1


UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "Window", "PythonUDF", "EvalPython", "InPandas", "Exchange SinglePartition, REPARTITION"]


@pytest.mark.parametrize(
    "name", sorted(n for n in QUERIES if not n.startswith(("stream_", "forest_", "daily_")))
)
def test_plan_has_no_unwanted_operator(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not [u for u in UNWANTED if u in plan]


def _scans(df):
    lines = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    ).splitlines()
    scans, current = {}, None
    for line in lines:
        if line.startswith("Location:"):
            current = line.rsplit("/", 1)[-1].removesuffix(".parquet]")
        if line.startswith(("PushedFilters", "ReadSchema")) and current:
            scans[current] = scans.get(current, "") + line
    return scans


def test_filters_and_columns_reach_the_scan(spark):
    day = _scans(QUERIES["requests_of_day"](spark, SMALL))["events"]
    assert "GreaterThanOrEqual(ts," in day and "user_id" not in day and "props" not in day
    months = _scans(QUERIES["flights_by_month"](spark, SMALL))["lineitem"]
    assert "l_shipdate" in months and "l_quantity" not in months and "l_tax" not in months


def test_monthly_totals_combine_before_the_shuffle(spark):
    plan = QUERIES["flights_by_month"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_session_time_zone_does_not_matter(spark, con):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("feature_table", "json_feature_file", "stream_awaited_responses", "daily_scoring", "requests_of_day"):
            assert differences(QUERIES[name](spark, SMALL), con, ORACLES[name]) == [], name
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")

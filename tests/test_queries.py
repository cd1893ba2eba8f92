"""Every registered query against its checking SQL, and the shape of the plans."""

import re

import pytest
from compare import connect, difference
from conftest import SMALL
from skytally.plans.oracles import ORACLES
from skytally.plans.registry import QUERIES

import __spark_entry__


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_registry_is_complete():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    result = difference(QUERIES[name](spark, SMALL), con, ORACLES[name])
    allowed = {"no rows"} if name in MAY_BE_EMPTY else set()
    assert result is None or result in allowed


# The smallest tables are too sparse for these (they have rows at every larger size).
MAY_BE_EMPTY = {"recent_critical", "drop_event_correlation", "baseline_series"}


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not re.match("stream|upsert|load|bronze_records|recent_history|new_scored|incremental|merge_history", n)))
def test_no_cross_product(spark, name):
    plan = _plan(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan


def _scans(df) -> int:
    """Scans that really run; branches that share an exchange count once."""
    df.collect()
    final = _plan(df).split("== Initial Plan ==")[0]
    return final.count("FileScan parquet")


@pytest.mark.parametrize("name", ["anomaly_score", "anomaly_score_dense", "rolling_baseline", "silver_to_gold"])
def test_scoring_reads_its_input_once(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert _scans(df) == 1
    assert "ReusedExchange" in _plan(df)


def test_only_needed_columns_are_read(spark):
    plan = _plan(QUERIES["traffic_by_bucket"](spark, SMALL))
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert "props" not in schema and "event_type" not in schema and "value" not in schema


def test_distinct_counts_are_folded_before_the_shuffle(spark):
    plan = _plan(QUERIES["traffic_by_bucket"](spark, SMALL))
    assert "partial_count(distinct" in plan


@pytest.mark.parametrize(
    "name", ["region_history", "baseline_series", "region_detail", "alerts_by_status", "status_counts", "alert_count", "alert_board", "airport_halos"]
)
def test_dashboard_reads_the_stored_table_once(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert _scans(df) == 1
    if name in ("region_history", "baseline_series", "region_detail"):
        assert "EqualTo(region,OTHER)" in _plan(df) and "GreaterThanOrEqual(bucket_sk" in _plan(df)

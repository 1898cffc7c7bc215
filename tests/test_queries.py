"""Every registered query against its SQL, and the shape of the plans."""

import os

import pytest

import __spark_entry__ as driver
import oracle_check
from helpers import plan
from roadpulse.plans import catalog, oracle

SF_DIR = os.environ.get("ROADPULSE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = catalog.queries(), oracle.oracle_sql()
JOBS = ("batch_audit", "alert_delivery", "document_rejects", "document_feed")
BATCH = [n for n in QUERIES if not n.startswith("stream_") and n not in JOBS]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return oracle_check.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    assert oracle_check.compare(QUERIES[name](spark, SF_DIR), duck, SQL[name]) == []


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", BATCH)
def test_plans_have_no_cross_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert operator not in text


def test_lookups_are_broadcast_by_size(spark):
    for name in ("corridor_status", "alert_cards", "weather_now", "ping_positions"):
        text = plan(QUERIES[name](spark, SF_DIR))
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_a_large_lookup_is_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16")
    try:
        text = plan(QUERIES["ping_positions"](spark, SF_DIR))
        assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
        con = oracle_check.connect(SF_DIR)
        df = QUERIES["ping_positions"](spark, SF_DIR)
        assert oracle_check.compare(df, con, SQL["ping_positions"]) == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["baselines"](spark, SF_DIR)).split("== Physical Plan ==")[1]
    assert "GreaterThanOrEqual(ts,2024-01-23T23:50)" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in text


def test_hot_keys_are_cut_before_the_shuffle(spark):
    assert "row_number(), 1, Partial" in plan(QUERIES["vehicle_snapshot"](spark, SF_DIR))
    for name in ("latest_per_corridor", "weather_clean", "weather_now"):
        text = plan(QUERIES[name](spark, SF_DIR)).split("== Physical Plan ==")[1]
        assert "partial_max_by" in text and "SortAggregate" not in text and "Sort [" not in text


def test_top_k_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["recent_alerts"](spark, SF_DIR))


def test_payloads_are_parsed_once(spark):
    for name in ("decode_weather", "route_document_flatten", "weather_document_flatten"):
        text = plan(QUERIES[name](spark, SF_DIR)).split("== Physical Plan ==")[1]
        assert text.count("from_json(") == 1

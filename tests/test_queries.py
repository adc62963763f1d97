"""Every registered query beside its SQL, and the shape of its plan."""

import pytest

import __spark_entry__ as contract
from compare import database, differences
from kelvane.plans import catalog

FOLDER = "/root/testdata/sf0.001"
QUERIES = {name: run for name, run in contract.queries().items() if name in catalog.QUERIES}
SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_its_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, FOLDER), connection, SQL[name]) is None


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


NO_PYTHON = [n for n in sorted(QUERIES) if not n.startswith(("stream_", "batch_wire"))
             and n not in ("raw_insert_replay", "aggregated_insert_replay", "alerts_append",
                           "hourly_refresh", "hourly_refresh_emptied", "published_order",
                           "payload_outcome_counts")]


@pytest.mark.parametrize("name", NO_PYTHON)
def test_plan_stays_in_the_engine(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for node in ("ArrowEvalPython", "MapInArrow", "MapInPandas", "BatchEvalPython",
                 "FlatMapGroupsInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = plan_of(QUERIES["count_readings"](spark, FOLDER))
    assert "ReadSchema: struct<>" in plan
    plan = plan_of(QUERIES["hourly_rollup"](spark, FOLDER))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan


@pytest.mark.parametrize("name", ["alerts_runs", "alerts_gap_reset", "alerts_redelivered"])
def test_alerts_scan_once(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    frame.collect()
    final = plan_of(frame).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_limits_are_top_k(spark):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["recent_readings"](spark, FOLDER))


def test_entry(spark):
    assert contract.entry(spark).columns == [
        "room", "window_start_ms", "max_temp", "consecutive_count"]


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)

"""The driver contract, the SQL counterparts, and what plans must and must not hold."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def test_contract(spark):
    found, sql = contract.queries(), contract.oracle_sql()
    assert set(sql) <= set(found) and len(found) >= 80
    assert contract.entry(spark).columns[:4] == ["date", "hour", "route_id", "direction_id"]


# their jobs, models and streams run in other tests; tools/compare.py runs these queries too
ELSEWHERE = ("job_", "stream_", "tuning_", "joint_", "gbt_", "rf_", "model_", "upsert_", "feature_scan", "pipeline", *(f"op{n}_" for n in range(1, 14)))


def test_queries_agree_with_their_sql(spark):
    from tools.compare import compare

    results = compare(spark, FOLDER, [n for n in contract.queries() if not n.startswith(ELSEWHERE)])
    wrong = {n: r for n, r in results.items() if not r.startswith(("ok", "rows only"))}
    assert not wrong


LAZY = [
    "hourly_occupancy", "occupancy_typed", "hourly_from_trips", "trip_route_resolution", "vehicle_filters", "feature_join",
    "feature_view", "prev_day_weather", "prev_day_weather_frame", "calendar_dim", "active_route_hours", "schedule_summary",
    "schedule_features", "trip_hours", "dedup_keep_last", "asof_feature", "dq_traffic", "confusion_matrix",
    "classification_report", "class_metrics", "merge_past_future", "dashboard_doc", "serving_view", "coverage_stats",
]


@pytest.mark.parametrize("name", LAZY)
def test_plans_stay_in_the_engine(spark, plan_of, name):
    plan = plan_of(contract.queries()[name](spark, FOLDER))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert word not in plan


def test_shuffles_are_few(spark, plan_of):
    exchanges = lambda name: plan_of(contract.queries()[name](spark, FOLDER)).count("Exchange hashpartitioning")
    assert exchanges("hourly_occupancy") == 1
    assert exchanges("trip_hours") == 1
    assert exchanges("dq_traffic") == 1
    for name in ("hourly_occupancy", "trip_hours"):
        assert "SortAggregate" not in plan_of(contract.queries()[name](spark, FOLDER))


def test_scans_read_only_what_is_used(spark, plan_of):
    plan = plan_of(contract.queries()["hourly_occupancy"](spark, FOLDER))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan


def test_large_sides_are_shuffled_not_broadcast(spark, plan_of):
    """With no room for broadcasts the same queries fall back to shuffled joins."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("active_route_hours", "trip_route_resolution", "merge_past_future"):
            plan = plan_of(contract.queries()[name](spark, FOLDER))
            assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)

"""Physical plans that must hold at scale."""

from __future__ import annotations

import datetime as dt

import pytest

from eventmart.catalogue.marts import QUERIES
from eventmart.catalogue.tables import events
from eventmart.operators.history import scd2
from eventmart.operators.joins import broadcast_if_small
from eventmart.operators.ordering import HOT_ROWS, top_per_group
from eventmart.plans.anomalies import anomaly_flags, country_steps
from eventmart.plans.content import content_engagement
from eventmart.plans.hourly import hourly_active_users
from eventmart.plans.monitors import rule_outcomes
from eventmart.plans.sessions import user_session_summary
from tests.conftest import SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def static_plans(spark):
    """Plans as they would be for large tables: no adaptive execution, no broadcast by size."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_content_scans_events_once(spark, static_plans):
    text = plan(content_engagement(events(spark, SMALL)))
    assert text.count("ReusedExchange") == 1
    assert text.count("FileScan") == 1


def test_sessions_are_one_scan_without_join(spark, static_plans):
    text = plan(user_session_summary(events(spark, SMALL)))
    assert text.count("FileScan") == 1 and "Join" not in text
    assert text.count("Exchange hashpartitioning") == 3
    # rows are multiplied for the two groupings only once they are counted
    assert text.index("Expand") < text.index("Exchange hashpartitioning(user_id#", text.index("Expand"))
    assert "FileScan" not in text[text.index("Expand") :].split("Exchange hashpartitioning")[0]


def test_anomaly_flags_scan_events_twice(spark, static_plans):
    text = plan(anomaly_flags(events(spark, SMALL)))
    assert text.count("FileScan") == 2
    assert "Window [lag(" in text and "FileScan" in text


def test_hourly_is_one_scan_and_reads_few_columns(spark, static_plans):
    raw = spark.read.parquet(f"{SMALL}/events.parquet")
    shaped = raw.selectExpr(
        "ts as timestamp", "user_id", "event_id", "event_type as platform", "event_type as country", "user_id as session_id"
    )
    text = plan(hourly_active_users(shaped))
    assert text.count("FileScan") == 1
    assert "props" not in text and "value#" not in text


def test_top_per_group_trims_before_the_shuffle(spark, static_plans):
    df = spark.read.parquet(f"{SMALL}/orders.parquet")
    text = plan(top_per_group(df, ["o_custkey"], [df.o_orderkey.desc()]))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_history_without_hot_keys_is_one_scan_and_two_sorts(spark, static_plans):
    """Once to find the greatest row per sequence, once along the key for both neighbours."""
    changes = spark.read.parquet(f"{SMALL}/orders.parquet").select("o_custkey", "o_orderdate", "o_orderstatus")
    text = plan(scd2(changes, ["o_custkey"], "o_orderdate"))
    assert text.count("FileScan") == 1 and "Join" not in text
    assert text.count("Exchange") == 2 and text.count("Window [") == 2


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_mart_has_a_cross_join(spark, static_plans, name):
    text = plan(QUERIES[name][0](spark, SMALL))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_country_steps_sort_per_user_and_chunk(spark, static_plans):
    text = plan(country_steps(events(spark, SMALL), hot_rows=HOT_ROWS))
    assert "Window [lag" in text and "Join" not in text
    assert "hashpartitioning(__key" in text


def test_broadcast_only_after_a_count(spark, static_plans):
    big, small = spark.range(100), spark.range(10)
    assert "BroadcastHashJoin" in plan(big.join(broadcast_if_small(small, 10), "id", "left_semi"))
    assert "BroadcastHashJoin" not in plan(big.join(broadcast_if_small(small, 9), "id", "left_semi"))


@pytest.mark.parametrize("match_dataset", [True, False])
def test_rule_outcomes_read_and_parse_the_log_once(spark, static_plans, tmp_path, match_dataset):
    origin = "struct('r' as request_id, 'p' as pipeline_name) as origin"
    spark.range(10).selectExpr("'flow_progress' as event_type", origin, "'{}' as details").write.parquet(f"{tmp_path}/log")
    pipelines = spark.createDataFrame([(1, "p")], "pipeline_id int, name string")
    at = "timestamp'2024-01-01' as period_start_time, timestamp'2024-01-01' as period_end_time"
    runs = spark.sql(f"select 1 as pipeline_id, 'r' as update_id, {at}")
    log = spark.read.parquet(f"{tmp_path}/log")
    text = plan(rule_outcomes(pipelines, runs, log, None, dt.datetime(2023, 1, 1), dt.datetime(2025, 1, 1), match_dataset))
    assert text.count("FileScan") == 1 and text.count("from_json") == 1
    assert text.index("from_json") < text.index("LeftSemi")  # printed top down: the runs are cut before parsing

"""Cases in which stored tables once lost, doubled or changed rows."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest

from eventmart.functions.privacy import mask, row_visible
from eventmart.operators.history import BUCKET, scd2, with_bucket
from eventmart.operators.merge import assert_unique
from eventmart.plans import runner
from eventmart.plans.privacy_views import create_privacy_view
from eventmart.sources.catalog import read_table
from eventmart.sources.landing import infer_csv_schema
from eventmart.streaming.history import apply_batch
from tests.conftest import rows


def _tag(*names):
    tag = uuid.uuid4().hex[:8]
    return [f"{n}_{tag}" for n in names]


def _at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


AD = "ad_id string, campaign_id string, budget_usd double, spend_usd double, updated_at timestamp"
EVENT = "event_id string, user_id string, event_type string, ad_id string, timestamp timestamp, updated_at timestamp"


def test_a_source_that_lags_loses_nothing(spark):
    silver, dim, target, marks = _tag("silver", "dim", "ads", "marks")

    def events(*data):
        made = [(str(i), "u", "ad_click", ad, _at(day), _at(day)) for i, ad, day in data]
        spark.createDataFrame(made, EVENT).write.mode("append").saveAsTable(silver)

    def ads(*data):
        spark.createDataFrame([(a, "c", 10.0, 1.0, _at(day)) for a, day in data], AD).write.mode("append").saveAsTable(dim)

    def run():
        runner.run_mart(spark, "ads", runner.ad_mart(), [silver, dim], target, marks, buckets=4)
        return {r.ad_id: r.ad_clicks_count for r in runner.read_mart(spark, target).collect()}

    events((1, "a", 1), (2, "b", 9))
    ads(("a", 1))
    assert run().get("a") == 1
    ads(("b", 2))  # a week behind the newest event
    assert run() == {"a": 1, "b": 1}
    assert {r.entity_name: r.watermark_value for r in read_table(spark, marks).collect()} == {"ads": _at(9), f"ads:{dim}": _at(2)}


def test_ad_mart_over_a_history_has_one_row_per_ad(spark):
    silver, dim, target, marks = _tag("silver", "dim", "ads", "marks")
    spark.createDataFrame([("1", "u", "ad_click", "a", _at(1), _at(1))], EVENT).write.saveAsTable(silver)
    changes = spark.createDataFrame([("a", "c1", 10.0, 1.0, _at(1)), ("a", "c2", 10.0, 5.0, _at(2))], AD)
    scd2(changes, ["ad_id"], "updated_at").write.saveAsTable(dim)
    runner.run_mart(spark, "ads", runner.ad_mart(), [silver, dim], target, marks, buckets=4)
    assert [(r.ad_id, r.campaign_id) for r in runner.read_mart(spark, target).collect()] == [("a", "c2")]


def test_buckets_are_kept(spark):
    silver, target, marks, history = _tag("silver", "mart", "marks", "history")
    made = [(str(i), f"u{i}", f"s{i}", "view", "iOS", _at(1), _at(1)) for i in range(20)]
    schema = "event_id string, user_id string, session_id string, event_type string, platform string, timestamp timestamp, updated_at timestamp"
    spark.createDataFrame(made, schema).write.saveAsTable(silver)
    runner.run_mart(spark, "s", runner.session_mart(), [silver], target, marks, buckets=8)
    with pytest.raises(ValueError, match="8 buckets"):
        runner.run_mart(spark, "s", runner.session_mart(), [silver], target, marks, buckets=4)
    assert runner.read_mart(spark, target).count() == 20

    changes = spark.createDataFrame([(i, "free", _at(1)) for i in range(20)], "user_id long, tier string, updated_at timestamp")
    staged = with_bucket(changes, ["user_id"], 8)
    with pytest.raises(ValueError, match="staged"):
        apply_batch(staged, staged, history, ["user_id"], "updated_at", buckets=4)
    apply_batch(staged, staged, history, ["user_id"], "updated_at", buckets=8)
    with pytest.raises(ValueError, match="8 buckets"):
        apply_batch(changes, changes, history, ["user_id"], "updated_at", buckets=16)
    assert read_table(spark, history).drop(BUCKET).count() == 20


def test_flags_keep_the_time_they_were_found(spark):
    silver, target, marks = _tag("silver", "flags", "marks")
    schema = "event_id string, user_id string, country string, ip_address string, timestamp timestamp, updated_at timestamp"

    def add(*data):
        made = [(i, "u", c, "a", _at(1, h), _at(1, arrived)) for i, c, h, arrived in data]
        spark.createDataFrame(made, schema).write.mode("append").saveAsTable(silver)

    def run():
        runner.run_mart(spark, "f", runner.anomaly_mart(), [silver], target, marks, buckets=4)
        return rows(runner.read_mart(spark, target))

    add(("1", "IN", 1, 5), ("2", "US", 3, 5))
    first = run()
    assert run() == first and len(first) == 1
    add(("3", "UK", 4, 6))
    again = run()
    old = [r for r in again if r[: len(first[0])] in first]
    assert old == first and len(again) == 2


def test_a_corrected_price_replaces_its_row(spark):
    (table,) = _tag("cost")
    schema = (
        "pipeline_id string, pipeline_name string, update_id string, sku_name string, usage_date date, usage_start_time timestamp, "
        "usage_end_time timestamp, dbu_consumed double, estimated_cost_usd double, workspace_id string"
    )

    def cost(*measures):
        return spark.createDataFrame([("p", "n", "u", "s", dt.date(2024, 1, 1), _at(1), _at(1, 1), d, c, "w") for d, c in measures], schema)

    runner.store_monitor(cost((1.0, 0.5)), "run_cost", table)
    runner.store_monitor(cost((1.0, 0.6)), "run_cost", table)
    assert [(r.dbu_consumed, r.estimated_cost_usd) for r in read_table(spark, table).collect()] == [(1.0, 0.6)]
    runner.store_monitor(cost((1.0, 0.5), (2.0, 1.0)), "run_cost", table)
    assert [(r.dbu_consumed, r.estimated_cost_usd) for r in read_table(spark, table).collect()] == [(3.0, 1.5)]


@pytest.mark.parametrize("role", ["admin\\", "x'", "', 'admin", "-- ", "a b", ""])
def test_hostile_roles_are_refused(spark, role):
    for use in (lambda r: mask("email", "email", r), lambda r: row_visible("country", r), lambda r: create_privacy_view(spark, "t", "v", [], r)):
        with pytest.raises(ValueError, match="role"):
            use([role, "admin"])


def test_rare_values_decide_a_type(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("n\n" + "".join("text\n" if i % 100 == 50 else f"{i}\n" for i in range(300)))
    assert infer_csv_schema(spark, f"file://{path}").simpleString() == "struct<n:string>"


def test_null_keys_are_no_duplicates_and_need_no_window(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    assert assert_unique(df, ["k"], nulls_equal=False).count() == 3
    with pytest.raises(Exception, match="more than one source row"):
        assert_unique(df.unionByName(df.filter("k = 'a'")), ["k"], nulls_equal=False).count()

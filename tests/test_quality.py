from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql.types import StructType

from eventmart import config
from eventmart.operators.project import typed_select
from eventmart.operators.quality import Rule, clean, expect, expect_drop, expect_fail, load_rules, rejected, rule_metrics
from eventmart.schemas import bronze_schema, silver_schema
from tests.conftest import rows

DAY = dt.date(2024, 5, 1)


def rule(field, predicate, action):
    return Rule(f"{field}-{action}", field, predicate, action)


def test_catalogue_counts(spark):
    rules = config.default_rules(spark, DAY)
    counts = {(e, a): len(load_rules(rules, e, DAY, a)) for e in ("users", "events", "ads") for a in ("drop", "warn", "fail")}
    assert counts == {
        ("users", "drop"): 3, ("users", "warn"): 3, ("users", "fail"): 0,
        ("events", "drop"): 4, ("events", "warn"): 2, ("events", "fail"): 0,
        ("ads", "drop"): 5, ("ads", "warn"): 2, ("ads", "fail"): 0,
    }
    assert load_rules(rules, "users", DAY - dt.timedelta(days=1)) == []


def test_only_active_rules_in_their_dates(spark):
    data = [
        ("1", "e", "a", "a > 0", "drop", True, dt.date(2024, 1, 1), None),
        ("2", "e", "a", "a < 9", "drop", True, None, dt.date(2024, 4, 30)),
        ("3", "e", "a", "a = 1", "drop", False, None, None),
        ("4", "e", "a", "a <> 5", "warn", True, dt.date(2024, 6, 1), None),
        ("5", "x", "a", "a <> 5", "warn", True, None, None),
    ]
    rules = spark.createDataFrame([(*d, "N") for d in data], config.RULES_SCHEMA)
    assert [r.rule_id for r in load_rules(rules, "e", DAY)] == ["1"]
    assert [r.rule_id for r in load_rules(rules, "e", dt.date(2024, 4, 1))] == ["1", "2"]


def test_drop_needs_every_rule_and_counts_unknown_as_failed(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (None, 1), (5, 1)], "a int, b int")
    rules = [rule("a", "a < 3", "drop"), rule("b", "b = 1", "drop"), rule("b", "b = 2", "warn")]
    assert rows(expect_drop(df, rules)) == [(1, 1)]


def test_fail_stops_the_job(spark):
    df = spark.createDataFrame([(1,), (None,)], "a int")
    rules = [rule("a", "a IS NOT NULL", "fail")]
    with pytest.raises(Exception, match="a-fail on a failed"):
        expect_fail(df, rules).collect()
    assert expect_fail(df.filter("a = 1"), rules).count() == 1


def test_warn_counts_and_keeps(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "a int")
    seen = Observation()
    kept = expect(df, [rule("a", "a IS NOT NULL", "warn")], seen)
    assert kept.count() == 3
    assert seen.get == {"total_records": 3, "failed_a-warn": 1}


def test_metrics(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "a int")
    got = rule_metrics(df, [rule("a", "a IS NOT NULL", "warn"), rule("a", "a > 9", "drop")]).collect()
    assert [tuple(r) for r in got] == [
        ("a-warn", "a", "warn", 2, 1, 3, 67.0),
        ("a-drop", "a", "drop", 0, 3, 3, 0.0),
    ]
    empty = rule_metrics(df.limit(0), [rule("a", "a > 9", "drop")]).collect()[0]
    assert empty.total_records == 0 and empty.pass_percentage is None


def test_ad_rule_with_malformed_flag(spark):
    rules = load_rules(config.default_rules(spark, DAY), "ads", DAY, "drop")
    data = [("1", "true", None), ("2", "maybe", None), ("3", "false", dt.date(2024, 1, 1)), ("4", None, dt.date(2024, 1, 1))]
    df = spark.createDataFrame(
        [(i, dt.datetime(2024, 1, 1), dt.date(2024, 1, 1), a, e) for i, a, e in data],
        "ad_id string, updated_at timestamp, start_date date, is_active string, end_date date",
    )
    assert [r.ad_id for r in expect_drop(df, rules).orderBy("ad_id").collect()] == ["1", "3"]


def test_typed_select_keeps_decimals_and_odd_names(spark):
    df = spark.createDataFrame([("1.25", "x")], "`a b` string, c string")
    out = typed_select(df, StructType.fromDDL("`a b` decimal(10,2), c int"))
    assert out.dtypes == [("a b", "decimal(10,2)"), ("c", "int")]
    assert [str(v) for v in out.collect()[0]] == ["1.25", "None"]


def test_clean_events(spark):
    names = bronze_schema("events").fieldNames()
    base = dict.fromkeys(names)

    def rec(**given):
        return tuple({**base, **given}[n] for n in names)

    good = dict(event_id="1", user_id="u", timestamp="2024-01-01 00:00:00", updated_at="2024-01-01 00:00:00", duration_ms="12", scroll_depth="x")
    bronze = spark.createDataFrame(
        [rec(**good), rec(**{**good, "event_id": None}), rec(**{**good, "timestamp": "soon"}), rec(**good, _rescued_data="{}")],
        bronze_schema("events"),
    )
    rules = load_rules(config.default_rules(spark, DAY), "events", DAY)
    out = clean(bronze, silver_schema("events"), rules).collect()
    assert [(r.event_id, r.duration_ms, r.scroll_depth) for r in out] == [("1", 12, None)]
    assert rejected(bronze).count() == 1

from __future__ import annotations

import datetime as dt
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.catalogue.tables import events
from eventmart.operators.ordering import drop_chunks, neighbour, split_hot
from eventmart.plans import anomalies
from eventmart.plans.anomalies import anomaly_cases, anomaly_flags, bucket_signals, country_steps
from tests.conftest import SMALL, rows

# (minute, address, country) per user, in order; the expected codes per event (0: not flagged).
HAND = {
    "A": ([(0, "a", "IN"), (0, "a", "IN"), (0, "a", "IN")], [1, 1, 1]),
    "B": ([(0, "a", "IN"), (1, "a", "US")], [0, 2]),
    "C": ([(0, "a", "IN"), (1, "b", "IN"), (2, "c", "IN")], [0, 0, 3]),
    "D": ([(0, "a", "IN"), (0, "a", "IN"), (0, "a", "US")], [1, 1, 4]),
    "E": ([(0, "a", "IN"), (0, "b", "IN"), (0, "c", "IN")], [5, 5, 5]),
    "F": ([(0, "a", "IN"), (1, "b", "IN"), (2, "c", "US")], [0, 0, 6]),
    "G": ([(0, "a", "IN"), (0, "b", "US"), (0, "c", "UK")], [5, 7, 7]),
    "H": ([(0, None, "IN")] * 3, [1, 1, 1]),
}


@pytest.fixture(scope="module")
def hand(spark):
    data = []
    for user, (given, _) in HAND.items():
        for i, (minute, address, country) in enumerate(given):
            at = dt.datetime(2024, 1, 1, 10, minute, i)
            data.append((f"{user}{i}", user, country, address, at))
    return spark.createDataFrame(
        data, "event_id string, user_id string, country string, ip_address string, timestamp timestamp"
    )


def test_hand_codes(hand):
    cases = anomaly_cases(hand, spike_gt=2, ip_gt=2)
    got = {}
    for r in cases.collect():
        got.setdefault(r.user_id, set()).add((r.bucket.minute, r.case_severity))
    for user, (given, codes) in HAND.items():
        expected = {(g[0], c) for g, c in zip(given, codes) if c}
        assert got.get(user, set()) == expected, user


def test_explode_drops_or_keeps_minutes_without_address(hand):
    inner = anomaly_flags(hand, spike_gt=2, ip_gt=2)
    outer = anomaly_flags(hand, spike_gt=2, ip_gt=2, explode_outer=True)
    assert inner.filter("user_id = 'H'").count() == 0
    kept = outer.filter("user_id = 'H'").collect()
    assert [(r.ip_address, r.case_severity, r.severity, r.flag_type) for r in kept] == [(None, 1, "low", "spike")]


def test_texts_of_all_codes(hand):
    flags = anomaly_flags(hand, spike_gt=2, ip_gt=2, explode_outer=True)
    texts = {r.case_severity: (r.flag_type, r.severity, r.flag_reason.count(";")) for r in flags.collect()}
    assert texts == {
        1: ("spike", "low", 0),
        2: ("suspicious", "low", 0),
        3: ("bot", "medium", 0),
        4: ("spike_suspicious", "medium", 1),
        5: ("spike_bot", "high", 1),
        6: ("suspicious_bot", "high", 1),
        7: ("spike_suspicious_bot", "high", 2),
    }


def test_country_gap_limits_changes(hand):
    wide = country_steps(hand, "30 minutes").filter("suspicious").count()
    narrow = country_steps(hand, "1 second").filter("suspicious").count()
    assert wide == country_steps(hand).filter("suspicious").count() == 5
    assert narrow == 0


def test_repeated_event_ids_count_once(spark):
    at = dt.datetime(2024, 1, 1)
    data = [("e1", "u", "IN", "a", at)] * 5 + [("e2", "u", "IN", "a", at)]
    df = spark.createDataFrame(
        data, "event_id string, user_id string, country string, ip_address string, timestamp timestamp"
    )
    signal = bucket_signals(df).collect()
    assert [(r.number_of_events, r.other_events, r.running_addresses) for r in signal] == [(2, 6, 1)]


def test_null_user_is_one_group(spark):
    data = [
        ("e1", None, "IN", "a", dt.datetime(2024, 1, 1, 0, 0)),
        ("e2", None, "US", "b", dt.datetime(2024, 1, 1, 0, 5)),
    ]
    df = spark.createDataFrame(
        data, "event_id string, user_id string, country string, ip_address string, timestamp timestamp"
    )
    flags = anomaly_flags(df).collect()
    assert [(r.user_id, r.ip_address, r.case_severity) for r in flags] == [(None, "b", 2)]


@pytest.mark.parametrize("bucket", ["minute", "hour", "day"])
@pytest.mark.parametrize("gap", [None, "12 hours"])
def test_edge_summaries_equal_a_window_over_events(spark, bucket, gap):
    """Sums per bucket of what ``lag`` over a user's steps says; times without seconds make many ties and shared minutes."""
    df = events(spark, SMALL).withColumn("timestamp", F.date_trunc("hour", "timestamp") + F.expr("make_interval(0, 0, 0, 0, 0, event_id % 2, event_id % 3)"))
    df = df.withColumn("timestamp", F.when(F.col("event_id") % 41 > 0, F.col("timestamp")))
    asked = "" if gap is None else f" and timestamp < before_at + interval {gap}"
    df.createOrReplaceTempView("plain")
    expected = spark.sql(f"""
        select user_id, bucket, count(distinct event_id) as n, sum(n_events) as rows_in, count_if(changed) as suspicious_events,
          min(if(changed, timestamp, null)) as first_suspicious, max(if(changed, timestamp, null)) as last_suspicious
        from (
          select *, coalesce(before <> country{asked}, false) and place = 1 as changed, 1 as n_events from (
            select *, date_trunc('{bucket}', timestamp) as bucket, lag(country) over w as before, lag(timestamp) over w as before_at,
              row_number() over (partition by user_id, timestamp, country order by event_id) as place
            from plain window w as (partition by user_id order by timestamp, country, event_id)))
        group by user_id, bucket""")
    got = bucket_signals(df, bucket, gap).withColumn("rows_in", F.col("suspicious_events") + F.col("other_events"))
    assert rows(got.selectExpr("user_id", "bucket", "number_of_events", "rows_in", "suspicious_events", "first_suspicious", "last_suspicious")) == rows(expected)


def test_summaries_of_two_halves_fold_as_the_whole(spark):
    whole = events(spark, SMALL)
    day = whole.withColumn("event_day", F.to_date("timestamp"))
    cut = F.col("timestamp") < "2024-01-15"
    halves = [anomalies.anomaly_partials(h, "event_day", bucket="hour") for h in (day.filter(cut), day.filter(~cut))]
    assert rows(anomalies.fold_signals(halves[0].unionByName(halves[1]))) == rows(bucket_signals(whole, "hour"))


@pytest.mark.parametrize("following", [False, True])
@pytest.mark.parametrize("hot_rows", [20, 70, 10_000])
def test_neighbour_equals_window(spark, following, hot_rows):
    df = events(spark, SMALL).select("user_id", "timestamp", "event_id", "country")
    order = ["timestamp", "event_id"]
    parts = [drop_chunks(neighbour(p, order, F.struct("event_id", "country"), "near", following)) for p in split_hot(df, ["user_id"], order, hot_rows)]
    got = reduce(DataFrame.unionByName, parts)
    df.createOrReplaceTempView("plain")
    word = "lead" if following else "lag"
    expected = spark.sql(
        f"""select event_id, {word}(event_id) over w as e, {word}(country) over w as c from plain
        window w as (partition by user_id order by timestamp, event_id)"""
    )
    assert rows(got.select("event_id", "near.event_id", "near.country")) == rows(expected)


@pytest.mark.parametrize("order", ["text", "day", "at"])
def test_chunks_of_any_order_are_bounded(spark, order):
    """A text, a date, and a burst within one second, all of one key."""
    df = spark.range(3000).select(
        F.lit("k").alias("key"), "id", F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.expr("date_add(date'2000-01-01', cast(id as int))").alias("day"),
        F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id / 1000000)").alias("at"),
    )
    cold, hot = split_hot(df, ["key"], [order], 200)
    assert cold.count() == 0 and hot.groupBy("__chunk").count().agg(F.max("count")).first()[0] <= 200
    got = neighbour(hot, [order], F.struct("id"), "near").selectExpr("id", "near.id")
    df.createOrReplaceTempView("burst")
    assert rows(got) == rows(spark.sql(f"select id, lag(id) over (partition by key order by {order}) as b from burst"))


def test_cells_at_larger_scale(spark):
    """Events per combination of spike, bot and suspicious, as counted by hand-written SQL."""
    s = bucket_signals(events(spark, "/root/testdata/sf0.01"), "day")
    cells = (
        s.withColumn("spike", F.col("number_of_events") > 7)
        .withColumn("bot", F.col("running_addresses") > 5)
        .groupBy("spike", "bot")
        .agg(F.sum("other_events").alias("n0"), F.sum("suspicious_events").alias("n1"))
    )
    got = {(r.spike, r.bot): (r.n0, r.n1) for r in cells.collect()}
    assert got == {
        (False, False): (1453, 648),
        (False, True): (5042, 2782),
        (True, False): (6, 2),
        (True, True): (48, 19),
    }

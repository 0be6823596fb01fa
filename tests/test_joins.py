"""Composite operators against brute force on random rows."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventmart.operators.history import scd2
from eventmart.operators.joins import interval_overlap_join, null_safe_join
from eventmart.operators.ordering import rank_by_value, running_distinct, top_per_group
from tests.conftest import rows

BASE = dt.datetime(2024, 1, 1)


def hours(n):
    return BASE + dt.timedelta(hours=n)


@pytest.mark.parametrize("seed", [1, 2])
def test_interval_overlap(spark, seed):
    rng = random.Random(seed)

    def spans(n, prefix):
        out = []
        for i in range(n):
            a = rng.randrange(0, 120)
            out.append((rng.choice("xy"), f"{prefix}{i}", hours(a), hours(a + rng.choice([0, 1, 24, 30, 70]))))
        return out

    left, right = spans(60, "l"), spans(40, "r")
    expected = sorted(
        (a[1], b[1])
        for a in left
        for b in right
        if a[0] == b[0] and (a[2] == b[2] or (a[2] < b[3] and b[2] < a[3]))
    )
    schema = "k string, {0}_id string, {0}_from timestamp, {0}_to timestamp"
    ldf = spark.createDataFrame(left, schema.format("l"))
    rdf = spark.createDataFrame(right, schema.format("r"))
    got = interval_overlap_join(ldf, rdf, ["k"], ("l_from", "l_to"), ("r_from", "r_to"))
    assert got.columns == ["k", "l_id", "l_from", "l_to", "r_id", "r_from", "r_to"]
    assert sorted((r.l_id, r.r_id) for r in got.collect()) == expected


def test_null_safe_join(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2), ("y", 3)], "k string, v int")
    b = spark.createDataFrame([(None, 10), ("x", 20), ("z", 30)], "k string, w int")
    assert rows(null_safe_join(a, b, ["k"], "inner")) == sorted([(None, 1, 10), ("x", 2, 20)], key=repr)
    assert rows(null_safe_join(a, b, ["k"], "left_anti")) == [("y", 3)]
    assert rows(null_safe_join(a, b, ["k"], "left_semi")) == sorted([(None, 1), ("x", 2)], key=repr)
    assert rows(null_safe_join(a, b, ["k"], "left")) == sorted([(None, 1, 10), ("x", 2, 20), ("y", 3, None)], key=repr)


def test_running_distinct_and_rank(spark):
    rng = random.Random(3)
    data = [(rng.choice("ab"), rng.randrange(20), rng.choice(["p", "q", "r", "s", None])) for _ in range(150)]
    df = spark.createDataFrame(data, "u string, b int, v string")
    expected = sorted(
        {(u, b, len({w for u2, b2, w in data if u2 == u and b2 <= b and w is not None})) for u, b, _ in data}
    )
    assert sorted(map(tuple, running_distinct(df, ["u"], "b", "v", "n").collect())) == expected

    scored = spark.createDataFrame([(None if u == "a" else u, b) for u, b, _ in data], "u string, score int")
    got = rank_by_value(scored, ["u"], "score", "r")
    plain = [tuple(r) for r in scored.collect()]
    expected = [(u, s, 1 + sum(1 for u2, s2 in plain if u2 == u and s2 > s)) for u, s in plain]
    assert rows(got) == sorted(expected, key=repr)


@pytest.mark.parametrize("hot_rows", [3, 1_000_000])
def test_history_against_a_plain_loop(spark, hot_rows):
    rng = random.Random(5)
    data = []
    for key in "abc":
        for minute in rng.sample(range(400), 25):
            data.append((key, BASE + dt.timedelta(seconds=20 * minute), rng.choice(["x", "y", None])))
    expected = []
    for key in "abc":
        last = []
        for _, at, value in sorted((d for d in data if d[0] == key), key=lambda d: d[1]):
            if not last or last[-1][1] != value:
                last.append((at, value))
        ends = [at for at, _ in last[1:]] + [None]
        expected += [(key, value, at, end, end is None) for (at, value), end in zip(last, ends)]
    h = scd2(spark.createDataFrame(data, "k string, at timestamp, v string"), ["k"], "at", hot_rows=hot_rows)
    assert rows(h.select("k", "v", "valid_from", "valid_to", "is_current")) == sorted(expected, key=repr)


def test_top_per_group_is_deterministic(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "w")], "k string, n int, t string")
    assert rows(top_per_group(df, ["k"], [F.desc("n"), F.col("t")])) == [("a", 2, "y"), ("b", None, "w")]

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventmart.catalogue.changes import _event_changes
from eventmart.operators.history import current_rows, scd2, scd2_apply, scd2_extend, sequence_state
from eventmart.operators.ordering import HOT_ROWS
from tests.conftest import SMALL, rows

SCHEMA = "user_id string, updated_at timestamp, tier string, batch string"


def day(n: int) -> dt.datetime:
    return dt.datetime(2024, 1, n)


def make(spark, *data):
    return spark.createDataFrame([(u, day(d), t, f"b{i}") for i, (u, d, t) in enumerate(data)], SCHEMA)


def versions(df):
    found = ((r.user_id, r.tier, r.valid_from.day, r.valid_to and r.valid_to.day, r.is_current) for r in df.collect())
    return sorted(found, key=repr)


def test_equal_repeat_makes_no_version(spark):
    h = scd2(make(spark, ("u", 1, "free"), ("u", 2, "free"), ("u", 3, "gold")), ["user_id"], "updated_at", ["tier"])
    assert versions(h) == [("u", "free", 1, 3, False), ("u", "gold", 3, None, True)]


def test_untracked_columns_make_no_version(spark):
    changes = make(spark, ("u", 1, "free"), ("u", 2, "free"))
    assert scd2(changes, ["user_id"], "updated_at", ["tier"]).count() == 1
    assert scd2(changes, ["user_id"], "updated_at").count() == 2


def test_null_values_are_compared(spark):
    h = scd2(make(spark, ("u", 1, None), ("u", 2, None), ("u", 3, "x"), ("u", 4, None)), ["user_id"], "updated_at", ["tier"])
    assert [(v[2], v[3]) for v in sorted(versions(h), key=lambda v: v[2])] == [(1, 3), (3, 4), (4, None)]


def test_same_sequence_keeps_one_row(spark):
    h = scd2(make(spark, ("u", 1, "a"), ("u", 1, "b")), ["user_id"], "updated_at", ["tier"])
    assert versions(h) == [("u", "b", 1, None, True)]


def test_late_change_between_two_equal_ones(spark):
    first = make(spark, ("u", 1, "free"), ("u", 5, "free"))
    h1 = scd2_apply(None, first, first, ["user_id"], "updated_at", ["tier"])
    assert versions(h1) == [("u", "free", 1, None, True)]
    late = make(spark, ("u", 3, "gold"))
    h2 = scd2_apply(h1, first.unionByName(late), late, ["user_id"], "updated_at", ["tier"])
    assert versions(h2) == [("u", "free", 1, 3, False), ("u", "free", 5, None, True), ("u", "gold", 3, 5, False)]


@pytest.mark.parametrize("hot_rows", [20, HOT_ROWS])
def test_batches_in_any_order_equal_one_run(spark, hot_rows):
    changes = _event_changes(spark, SMALL)
    rule = (["user_id"], ["ts", "event_id"], ["event_type"])
    whole = rows(scd2(changes, *rule))
    kinds = ["view", "click", "signup", "error", "purchase"]
    random.Random(7).shuffle(kinds)
    staged, history = None, None
    for kind in kinds:
        batch = changes.filter(changes.event_type == kind)
        staged = batch if staged is None else staged.unionByName(batch)
        history = scd2_apply(history, staged, batch, *rule, hot_rows=hot_rows)
        history = spark.createDataFrame(history.collect(), history.schema)
    assert rows(history) == whole
    again = scd2_apply(history, staged, batch, *rule, hot_rows=hot_rows)
    assert rows(again) == whole


def test_current_has_one_row_per_key(spark):
    changes = _event_changes(spark, SMALL)
    now = current_rows(scd2(changes, ["user_id"], ["ts", "event_id"], ["event_type"]))
    assert now.count() == changes.select("user_id").distinct().count()


def test_counts_at_larger_scale(spark):
    h = scd2(_event_changes(spark, "/root/testdata/sf0.01"), ["user_id"], ["ts", "event_id"], ["event_type"])
    assert (h.count(), h.filter("is_current").count()) == (8016, 150)


def test_number_sequence_on_hot_keys(spark):
    changes = spark.createDataFrame([("k", i * 60_000, "ab"[i % 7 == 0]) for i in range(50)], "key string, seq long, v string")
    plain = scd2(changes, ["key"], "seq")
    split = scd2(changes, ["key"], "seq", hot_rows=10)
    assert rows(plain) == rows(split)


def refuse():
    raise AssertionError("staged changes are read")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_extended_batches_equal_one_run(spark, seed):
    """Batches in order read no staged changes; late, repeated and shuffled ones end in the same history and state."""
    rng = random.Random(seed)
    data = [(rng.choice(["u", "v", "w", None]), dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), rng.choice(["a", "b", None])) for h in range(40)]
    rule = (["user_id"], "updated_at", ["tier"])

    def table(some):
        return spark.createDataFrame([(u, t, x, "b") for u, t, x in some], SCHEMA)

    whole = table(data)
    expected, last = rows(scd2(whole, *rule)), rows(sequence_state(whole, *rule[:2]))
    empty = scd2(table([]), *rule), sequence_state(table([]), *rule[:2])
    in_order = [data[i : i + 10] for i in range(0, 40, 10)]
    shuffled = rng.sample(data, 40)
    mixed = [data[:15], shuffled[:5], data[5:30], shuffled[10:], data[30:], data[30:]]
    for batches in (in_order, mixed, [shuffled[i::3] for i in range(3)]):
        (history, state), staged = empty, []
        for some in batches:
            staged += some
            history, state = scd2_extend(history, state, refuse if batches is in_order else table(staged), table(some), *rule)
            history, state = (spark.createDataFrame(x.collect(), x.schema) for x in (history, state))
        assert rows(history) == expected and rows(state) == last


def test_a_state_older_than_its_history_does_no_harm(spark):
    """As after a stop between the two writes: the batch comes again."""
    first, second = make(spark, ("u", 1, "a")), make(spark, ("u", 2, "b"), ("u", 3, "b"), ("u", 4, "c"))
    rule = (["user_id"], "updated_at", ["tier"])
    whole = first.unionByName(second)
    done, old = scd2(whole, *rule), sequence_state(first, *rule[:2])
    history, state = scd2_extend(done, old, whole, second, *rule)
    assert rows(history) == rows(done) and rows(state) == rows(sequence_state(whole, *rule[:2]))
    # a history without a state, as written by earlier versions, is rebuilt key by key
    history, state = scd2_extend(done, old.limit(0), whole, second, *rule)
    assert rows(history) == rows(done) and rows(state) == rows(sequence_state(whole, *rule[:2]))
    gap = make(spark, ("u", 5, "d")).withColumn("updated_at", F.lit(None).cast("timestamp"))
    both = whole.unionByName(gap)
    assert rows(scd2_extend(done, state, both, gap, *rule)[0]) == rows(scd2(both, *rule))

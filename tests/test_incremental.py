from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from eventmart.catalogue.tables import ads, events
from eventmart.operators.incremental import (
    advance_watermark,
    empty_watermarks,
    in_days,
    incremental_slice,
    reset_watermark,
    touched_days,
    watermark_value,
)
from eventmart.plans import runner
from eventmart.sources.catalog import read_table
from tests.conftest import SMALL, rows

CUTS = [dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20, 12), dt.datetime(2024, 2, 1)]


def test_slice_reaches_the_scan(spark):
    df = spark.read.parquet(f"{SMALL}/events.parquet").withColumnRenamed("ts", "updated_at")
    cut = incremental_slice(df, dt.datetime(2024, 1, 20), late="30 minutes")
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(updated_at" in plan or "GreaterThan(ts" in plan
    assert cut.count() == df.filter("updated_at > '2024-01-19 23:30:00'").count()
    assert incremental_slice(df, None).count() == df.count()


def test_watermark_table(spark):
    wm = advance_watermark(empty_watermarks(spark), "m", dt.datetime(2024, 1, 1))
    wm = advance_watermark(wm, "n", dt.datetime(2024, 1, 2))
    wm = advance_watermark(wm, "m", dt.datetime(2024, 1, 3))
    assert watermark_value(wm, "m") == dt.datetime(2024, 1, 3)
    assert watermark_value(wm, "x") is None and watermark_value(None, "m") is None
    assert watermark_value(reset_watermark(wm, "m"), "m") is None
    assert reset_watermark(wm, "m").count() == 1


MARTS = {
    "hourly": (runner.hourly_mart(), False),
    "sessions": (runner.session_mart(), False),
    "content": (runner.content_mart(), False),
    "ads": (runner.ad_mart(), True),
    "anomalies": (
        runner.anomaly_mart(bucket="day", spike_gt=7, ip_gt=5, now=None),
        False,
    ),
}


@pytest.mark.parametrize("name", list(MARTS))
def test_slices_equal_one_full_run(spark, name):
    mart, with_ads = MARTS[name]
    tag = uuid.uuid4().hex[:8]
    silver, dim, target, marks = (f"{n}_{tag}" for n in ("silver", "dim", "mart", "marks"))
    every = events(spark, SMALL)
    # Some records reach the table late, within the buffer.
    every = every.withColumn("updated_at", F.col("timestamp") + F.expr("interval 5 minutes"))
    tables = [silver]
    if with_ads:
        ads(spark, SMALL).withColumn("updated_at", F.lit(CUTS[0]) - F.expr("interval 9 days")).write.saveAsTable(dim)
        tables.append(dim)
    low = dt.datetime(2000, 1, 1)
    for high in CUTS:
        part = every.filter((F.col("updated_at") > F.lit(low)) & (F.col("updated_at") <= F.lit(high)))
        part.write.mode("append").saveAsTable(silver)
        runner.run_mart(spark, name, mart, tables, target, marks, buckets=4)
        low = high
    whole = mart.build(*[mart.prepare(spark.table(t)) for t in tables])
    skip = "detection_timestamp"
    expected = rows(whole.drop(skip))
    assert rows(runner.read_mart(spark, target).select(*whole.columns).drop(skip)) == expected
    assert watermark_value(read_table(spark, marks), name) == every.agg(F.max("updated_at")).take(1)[0][0]

    # The same slice again changes nothing; neither does a full refresh.
    runner.run_mart(spark, name, mart, tables, target, marks, buckets=4)
    assert rows(runner.read_mart(spark, target).select(*whole.columns).drop(skip)) == expected
    if name == "hourly":
        runner.run_mart(spark, name, mart, tables, target, marks, refresh="full")
        assert rows(runner.read_mart(spark, target).select(*whole.columns)) == expected
        assert watermark_value(read_table(spark, marks), name) is not None
        with pytest.raises(ValueError):
            runner.run_mart(spark, name, mart, tables, target, marks, refresh="some")


def test_a_case_taken_back_leaves_the_table(spark):
    """A late event without country undoes the only case of its partition."""
    tag = uuid.uuid4().hex[:8]
    silver, target, marks = f"silver_{tag}", f"flags_{tag}", f"marks_{tag}"
    schema = "event_id string, user_id string, country string, ip_address string, timestamp timestamp, updated_at timestamp"

    def add(*data):
        made = [(i, u, c, "a", dt.datetime(2024, 1, 1, h), dt.datetime(2024, 1, 1, arrived)) for i, u, c, h, arrived in data]
        spark.createDataFrame(made, schema).write.mode("append").saveAsTable(silver)

    def flagged():
        runner.run_mart(spark, "flags", runner.anomaly_mart(), [silver], target, marks, buckets=997)
        return sorted((r.user_id, r.event_timestamp) for r in runner.read_mart(spark, target).collect())

    add(("1", "u", "IN", 1, 5), ("2", "u", "US", 3, 5), ("3", "v", "IN", 1, 5), ("4", "v", "UK", 2, 5))
    assert flagged() == [("u", "2024-01-01 03:00"), ("v", "2024-01-01 02:00")]
    add(("5", "u", None, 2, 6))
    assert flagged() == [("v", "2024-01-01 02:00")]
    assert flagged() == [("v", "2024-01-01 02:00")]


def test_days_become_few_ranges(spark):
    df = spark.createDataFrame(
        [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * i)) for i in range(60)] + [(99, None)], "id int, timestamp timestamp"
    )
    days = touched_days(df)
    assert days[0] == dt.date(2024, 1, 1) and days[-1] is None and len(days) == 19
    for chosen in ([], days, days[2:4] + days[9:10], days[::2], [None]):
        expected = rows(df.filter(F.coalesce(F.to_date("timestamp").isin([d for d in chosen if d]), F.lit(False)) | (F.col("timestamp").isNull() & F.lit(None in chosen))))
        for most in (1, 2, 64):
            assert rows(in_days(df, chosen, most_ranges=most)) == expected


def test_refresh_reads_the_days_of_the_slice_only(spark):
    """Every scan of silver carries the day's bounds or the slice's; one late record adds its own day."""
    tag = uuid.uuid4().hex[:8]
    silver, target, marks = f"silver_{tag}", f"mart_{tag}", f"marks_{tag}"
    every = events(spark, SMALL)
    old = every.filter(F.col("timestamp") < F.lit(CUTS[1]))
    old.withColumn("day", F.to_date("timestamp")).repartition("day").write.partitionBy("day").saveAsTable(silver)
    runner.run_mart(spark, "s", runner.session_mart(), [silver], target, marks, buckets=4)

    def files(table, column):
        return {r[0]: r[1] for r in read_table(spark, table).select("_metadata.file_path", column).distinct().collect()}

    before = files(runner.partials_table(target), runner.DAY)
    late = old.orderBy("timestamp").limit(1).withColumn("event_id", F.lit(-1).cast("long")).withColumn("updated_at", F.lit(CUTS[2]))
    late.withColumn("day", F.to_date("timestamp")).write.insertInto(silver)
    day = late.select(F.to_date("timestamp")).first()[0]
    mart, table = runner.session_mart(), read_table(spark, silver)
    fresh = runner.refresh_partials(mart, read_table(spark, runner.partials_table(target)), table, [day])
    scans = [x for x in fresh._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x and silver in x]
    assert scans and all("GreaterThanOrEqual(timestamp" in x and "LessThan(timestamp" in x for x in scans)
    runner.run_mart(spark, "s", mart, [silver], target, marks, buckets=4)
    after = files(runner.partials_table(target), runner.DAY)
    changed = {before[f] for f in before.keys() - after.keys()}
    assert day in changed and changed <= {day, dt.date(2024, 1, 19), dt.date(2024, 1, 20)}
    assert rows(runner.read_mart(spark, target)) == rows(mart.build(read_table(spark, silver)).select(*runner.read_mart(spark, target).columns))


def test_hourly_refresh_leaves_other_days_alone(spark):
    tag = uuid.uuid4().hex[:8]
    silver, target, marks = f"silver_{tag}", f"hourly_{tag}", f"marks_{tag}"
    every = events(spark, SMALL)
    early = F.col("timestamp") < F.lit(CUTS[1])

    def files():
        found = read_table(spark, target).select("date", "_metadata.file_path").distinct()
        return {(r[0], r[1]) for r in found.collect()}

    every.filter(early).write.saveAsTable(silver)
    runner.run_mart(spark, "h", runner.hourly_mart(), [silver], target, marks)
    before = files()
    every.filter(~early).write.mode("append").saveAsTable(silver)
    runner.run_mart(spark, "h", runner.hourly_mart(), [silver], target, marks)
    kept = before & files()
    assert {d for d, _ in kept} == {d for d, _ in before if d < "2024-01-20"}


def test_erase_from_tables(spark):
    tag = uuid.uuid4().hex[:8]
    gold, silver = f"gold_{tag}", f"silver_{tag}"
    e = events(spark, SMALL)
    runner.session_mart().build(e).write.saveAsTable(gold)
    e.write.saveAsTable(silver)
    gone = spark.createDataFrame([(1,), (2,)], "user_id long")
    runner.erase_from_tables(spark, [(gold, "user_id"), (silver, "user_id")], gone, "user_id")
    for t in (gold, silver):
        assert spark.table(t).filter("user_id in (1, 2)").count() == 0
    assert spark.table(silver).count() == e.filter("user_id not in (1, 2)").count()

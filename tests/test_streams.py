from __future__ import annotations

import datetime as dt
import json
import os
import shutil
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from eventmart import config
from eventmart.catalogue.changes import _event_changes
from eventmart.operators.history import BUCKET, scd2
from eventmart.operators.project import typed_select
from eventmart.operators.quality import accepted, clean, load_rules, read_counters, rule_metrics, store_counters
from eventmart.schemas import bronze_schema, silver_schema, source_schema
from eventmart.session import shared_folder
from eventmart.sources import landing
from eventmart.sources.catalog import read_table
from eventmart.sources.landing import landing_counts, landing_path, read_landing_csv, read_landing_json
from eventmart.streaming.history import apply_batch, run_history
from eventmart.streaming.ingest import clean_folder, count_folder, ingest_landing
from tests.conftest import SMALL, rows


def write(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def event(i, **more):
    base = {"event_id": str(i), "user_id": "u", "timestamp": "2024-01-01 00:00:00", "updated_at": "2024-01-01 00:00:00"}
    return json.dumps({**base, **more})


def test_rescue_of_landing_json(spark, root):
    write(f"{root}/events/batch_001/a.json", event(1), event(2, extra="z", n=5), "not json", "", event(3, country=None))
    got = read_landing_json(spark, landing_path(root, "events"), source_schema("events"))
    assert got.schema.simpleString() == bronze_schema("events").simpleString()
    seen = {r.event_id: r for r in got.collect()}
    assert json.loads(seen["2"]._rescued_data) == {"extra": "z", "n": "5"}
    assert seen["1"]._rescued_data is None and seen["3"]._rescued_data is None
    assert seen[None]._rescued_data == "not json"
    assert len(seen) == 4
    assert seen["1"].source_file_name == "a.json" and seen["1"].source_file_path.endswith("batch_001/a.json")
    assert isinstance(seen["1"].ingestion_timestamp, dt.datetime)


def test_rescue_of_landing_csv(spark, root):
    schema = StructType([StructField(n, StringType()) for n in ("user_id", "tier")])
    write(f"{root}/users/a.csv", "user_id,tier", "1,free", "2,gold,more", "3")
    got = {r.user_id: r._rescued_data for r in read_landing_csv(spark, landing_path(root, "users"), schema).collect()}
    assert got == {"1": None, "2": "2,gold,more", "3": "3"}
    counts = landing_counts(spark, root, {"users": "users/*.csv"}).collect()
    assert [(c.entity, c.n_files, c.n_records) for c in counts] == [("users", 1, 3)]


def test_every_csv_file_is_read_by_its_own_header(spark, root):
    schema = StructType.fromDDL("user_id string, tier string, n int")
    write(f"{root}/users/a.csv", "", "user_id,tier,n", "1,free,5", "2,gold,x", '3,"a, b",7', "", "user_id,tier,n")
    write(f"{root}/users/b.csv", "n,extra,USER_ID ", "5,more,4", "7,,5", "8,x", ",,")
    write(f"{root}/users/c.csv", "tier,tier,,user_id", "g,h,i,6")
    write(f"{root}/users/empty.csv", "")
    got = read_landing_csv(spark, landing_path(root, "users"), schema).select("user_id", "tier", "n", "_rescued_data")
    assert rows(got) == sorted(
        [
            ("1", "free", 5, None), ("2", "gold", None, '{"n":"x"}'), ("3", "a, b", 7, None),
            ("4", None, 5, '{"extra":"more"}'), ("5", None, 7, None), (None, None, 8, "8,x"), (None, None, None, None),
            ("6", "g", None, '{"tier_2":"h","column_3":"i"}'),
        ],
        key=repr,
    )
    none = read_landing_csv(spark, f"{root}/users/empty.csv", schema)
    assert none.count() == 0 and none.columns[:3] == schema.fieldNames()


def test_a_header_holds_for_all_blocks_of_its_file(spark, root):
    lines = [f"{i},{'x' * 50},{i % 7}" for i in range(2000)]
    write(f"{root}/users/big.csv", "n,tier,user_id", *lines)
    write(f"{root}/users/other.csv", "user_id,n,tier", *[f"{i % 7},{i},y" for i in range(500)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = read_landing_csv(spark, landing_path(root, "users"), StructType.fromDDL("user_id int, n int, tier string"))
        assert got.rdd.getNumPartitions() > 4
        assert got.filter("_rescued_data is not null or user_id != n % 7").count() == 0 and got.count() == 2500
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_too_many_headers_are_refused(spark, root, monkeypatch):
    monkeypatch.setattr(landing, "MOST_HEADERS", 2)
    for i in range(3):
        write(f"{root}/users/{i}.csv", f"user_id,c{i}", "1,2")
    with pytest.raises(ValueError, match="headers"):
        read_landing_csv(spark, landing_path(root, "users"), StructType.fromDDL("user_id string"))


def test_a_repeated_csv_batch_replaces_its_rows(spark, root):
    schema = StructType.fromDDL("user_id string")
    write(f"{root}/users/a.csv", "user_id", "1", "2")
    bronze = f"{root}/bronze"

    def run():
        ingest_landing(spark, landing_path(root, "users"), "csv", schema, bronze, f"{root}/cp").awaitTermination()
        return sorted(r.user_id for r in spark.read.parquet(bronze).collect())

    assert run() == ["1", "2"]
    os.remove(f"{root}/cp/commits/0")  # as if it stopped before the batch was committed
    if os.path.exists(f"{root}/cp/commits/.0.crc"):
        os.remove(f"{root}/cp/commits/.0.crc")
    assert run() == ["1", "2"]
    write(f"{root}/users/b.csv", "extra,user_id", "x,3")
    assert run() == ["1", "2", "3"]


def test_counters_of_a_stream_equal_those_of_a_batch(spark, root):
    land, bronze, counters = landing_path(root, "events"), f"{root}/bronze", f"{root}/counters"
    rules = load_rules(config.default_rules(spark), "events")

    def run():
        ingest_landing(spark, land, "json", source_schema("events"), bronze, f"{root}/c1").awaitTermination()
        count_folder(
            spark, bronze, bronze_schema("events"), silver_schema("events"), rules, counters, "events", f"{root}/c2", "run"
        ).awaitTermination()

    write(f"{root}/events/batch_001/a.json", event(1), event(2, extra="z"), "not json", event(3, user_id=None))
    run()
    write(f"{root}/events/batch_002/b.json", event(4, country="IN"), event(5, event_id=None))
    run()
    typed = typed_select(accepted(read_landing_json(spark, land, source_schema("events"))), silver_schema("events"))
    expected = {(r.rule_id, r.passed_records, r.failed_records, r.total_records) for r in rule_metrics(typed, rules).collect()}
    sums = read_counters(spark, counters).groupBy("rule_id").agg(F.sum("passed_records"), F.sum("failed_records"), F.sum("total_records"))
    assert {tuple(r) for r in sums.collect()} == expected
    drop = next(r for r in sums.collect() if r.rule_id == "events-user_id-drop")
    assert drop[2] == 1  # dropped rows are counted too

    # A batch that comes again replaces its counters, whatever they say.
    before = rows(read_counters(spark, counters).filter("batch_id = 0"))
    store_counters(typed.limit(1), rules, counters, "events", 1, "run")
    store_counters(typed.limit(1), rules, counters, "other", 0, "run")
    changed = read_counters(spark, counters)
    assert rows(changed.filter("stream = 'events' and batch_id = 0")) == before
    assert changed.filter("total_records = 1").count() == 2 * len(rules)


def test_bronze_and_silver_streams(spark, root):
    land = landing_path(root, "events")
    bronze, silver = f"{root}/bronze", f"{root}/silver"
    rules = load_rules(config.default_rules(spark), "events")

    def run():
        ingest_landing(spark, land, "json", source_schema("events"), bronze, f"{root}/c1").awaitTermination()
        query = clean_folder(
            spark, bronze, bronze_schema("events"), silver, silver_schema("events"), rules, f"{root}/c2", "warnings",
            date_of="timestamp",
        )
        query.awaitTermination()
        return [p["observedMetrics"] for p in map(dict, query.recentProgress) if p.get("observedMetrics")]

    write(f"{root}/events/batch_001/a.json", event(1), event(2, extra="z"), "not json", event(3, user_id=None))
    metrics = run()
    assert spark.read.parquet(silver).count() == 1
    # Warnings are counted before rows are dropped: records 1 and 3 have no country.
    assert metrics and metrics[0]["warnings"]["total_records"] == 2
    assert metrics[0]["warnings"]["failed_events-country-warn"] == 2

    # Files already taken in are not read again; new ones are.
    write(f"{root}/events/batch_002/b.json", event(4), event(5))
    run()
    run()
    batch = clean(read_landing_json(spark, land, source_schema("events")), silver_schema("events"), rules)
    columns = silver_schema("events").fieldNames()[:18]
    assert rows(spark.read.parquet(silver).select(*columns)) == rows(batch.select(*columns))
    assert spark.read.parquet(bronze).count() == 6
    assert sorted(d for d in os.listdir(silver) if "=" in d) == ["event_date=2024-01-01"]


def test_history_stream_equals_batch(spark, root):
    changes = _event_changes(spark, SMALL)
    staged, table = f"{root}/staged", f"history_{uuid.uuid4().hex[:8]}"
    rule = (["user_id"], ["ts", "event_id"], ["event_type"])

    def stream():
        run_history(spark, staged, changes.schema, table, f"{root}/cp", *rule, files_per_trigger=1, buckets=4).awaitTermination()

    done = None
    # The latest part arrives first.
    for kind in ("purchase", "view", "click"):
        part = changes.filter(F.col("event_type") == kind)
        part.coalesce(1).write.mode("append").parquet(staged)
        done = part if done is None else done.unionByName(part)
        stream()
    expected = rows(scd2(done, *rule))
    assert rows(read_table(spark, table).drop(BUCKET)) == expected

    # The same batch twice leaves the table as it is.
    apply_batch(part, spark.read.parquet(staged), table, *rule, buckets=4)
    assert rows(read_table(spark, table).drop(BUCKET)) == expected


def test_a_backlog_is_taken_in_at_once(spark, root, monkeypatch):
    changes = _event_changes(spark, SMALL)
    staged, table, calls = f"{root}/staged files", f"history_{uuid.uuid4().hex[:8]}", []
    rule = (["user_id"], ["ts", "event_id"], ["event_type"])

    def counted(batch, *args):
        calls.append(batch.count())
        return apply_batch(batch, *args)

    monkeypatch.setattr("eventmart.streaming.history.apply_batch", counted)

    def stream(checkpoint):
        run_history(
            spark, staged, changes.schema, table, f"{root}/{checkpoint}", *rule, files_per_trigger=1, buckets=4, location=f"{root}/history"
        ).awaitTermination()
        return rows(read_table(spark, table).drop(BUCKET))

    late = changes.filter("event_type in ('view', 'click')")
    first = changes.filter("event_type not in ('view', 'click')")
    # Six files wait: one rewrite, not six.
    first.repartition(6).write.parquet(staged)
    assert stream("cp") == rows(scd2(first, *rule))
    assert calls == [first.count()]
    # Files that arrive later, with late changes for the same keys, are read without the others.
    late.repartition(3).write.mode("append").parquet(staged)
    expected = rows(scd2(changes, *rule))
    assert stream("cp") == expected
    assert calls == [first.count(), late.count()]
    # From a new checkpoint all files come again; none is taken in twice.
    assert stream("cp2") == expected and len(calls) == 2
    # Without the history they all are.
    spark.sql(f"drop table {table}")
    shutil.rmtree(f"{root}/history")
    assert stream("cp3") == expected and calls[2:] == [changes.count()]


def test_batches_in_order_read_no_staged_changes(spark):
    changes = _event_changes(spark, SMALL)
    table = f"history_{uuid.uuid4().hex[:8]}"
    rule = (["user_id"], ["ts", "event_id"], ["event_type"])
    cuts = ["2024-01-08", "2024-01-16", "2025-01-01"]

    def refuse():
        raise AssertionError("staged changes are read")

    low = "2000-01-01"
    for high in cuts:
        part = changes.filter((F.col("ts") >= low) & (F.col("ts") < high))
        # the first batch creates the table from all that is staged
        apply_batch(part, part if low == "2000-01-01" else refuse, table, *rule, buckets=4)
        low = high
    assert rows(read_table(spark, table).drop(BUCKET)) == rows(scd2(changes, *rule))


def test_csv_users_to_history(spark, root):
    """Landing CSV to bronze, to bucketed staged changes, to history."""
    names = source_schema("users").fieldNames()

    def user(i, tier, day):
        values = dict.fromkeys(names, "x")
        values.update(user_id=str(i), tier=tier, signup_date="2024-01-01", updated_at=f"2024-01-{day:02d} 00:00:00")
        return ",".join(values[n] for n in names)

    table = f"users_{uuid.uuid4().hex[:8]}"
    bronze, staged = f"{root}/bronze", f"{root}/staged"
    rules = load_rules(config.default_rules(spark), "users")
    staged_type = StructType(silver_schema("users").fields + StructType.fromDDL(f"{BUCKET} int").fields)

    def run():
        ingest_landing(spark, landing_path(root, "users"), "csv", source_schema("users"), bronze, f"{root}/c1").awaitTermination()
        clean_folder(
            spark, bronze, bronze_schema("users"), staged, silver_schema("users"), rules, f"{root}/c2", bucket_keys=["user_id"]
        ).awaitTermination()
        run_history(spark, staged, staged_type, table, f"{root}/c3", ["user_id"], "updated_at", ["tier"]).awaitTermination()
        return sorted((r.user_id, r.tier, r.valid_from.day, r.valid_to and r.valid_to.day) for r in read_table(spark, table).collect())

    write(f"{root}/users/a.csv", ",".join(names), user(1, "free", 1), user(2, "gold", 1), "broken")
    assert run() == [("1", "free", 1, None), ("2", "gold", 1, None)]
    write(f"{root}/users/b.csv", ",".join(names), user(1, "gold", 9), user(1, "free", 5))
    assert run() == [("1", "free", 1, 9), ("1", "gold", 9, None), ("2", "gold", 1, None)]


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = shared_folder(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir")) and (base is None or path.startswith(base))

from __future__ import annotations

import datetime as dt
import uuid
from decimal import Decimal

import pytest

from eventmart.plans.monitors import (
    event_log_tables,
    folder_growth,
    previous_days,
    read_event_logs,
    rule_outcomes,
    run_cost,
    run_health,
    table_growth,
)
from eventmart.plans.runner import MONITOR_KEYS, store_monitor
from eventmart.sources.catalog import read_table, table_names
from tests.conftest import SMALL, rows


def at(hour, day=1):
    return dt.datetime(2024, 5, day, hour)


START, END = at(0), at(0, 2)


@pytest.fixture(scope="module")
def pipelines(spark):
    return spark.createDataFrame([("p1", "batch"), ("p2", "streaming")], "pipeline_id string, name string")


@pytest.fixture(scope="module")
def runs(spark):
    return spark.createDataFrame(
        [
            ("p1", "u1", "COMPLETED", "JOB", at(1), at(2)),
            ("p1", "u1", "COMPLETED", "JOB", at(1), at(2)),
            ("p1", "u2", "FAILED", "USER", at(23), at(0, 2)),
            ("p1", "u0", "COMPLETED", "JOB", dt.datetime(2024, 4, 30, 23), at(1)),
            ("p2", "u3", "COMPLETED", "JOB", at(4), at(5)),
        ],
        "pipeline_id string, update_id string, result_state string, trigger_type string, "
        "period_start_time timestamp, period_end_time timestamp",
    )


def test_health(spark, pipelines, runs):
    got = run_health(pipelines, runs, ["batch"], START, END)
    assert rows(got) == [("p1", "batch", "u1", "COMPLETED", "JOB", at(1), at(2), 3600)]
    names = spark.createDataFrame([("batch",), ("streaming",)], "name string")
    assert run_health(pipelines, runs, names, START, END).count() == 2
    assert run_health(pipelines, runs, None, START, END).count() == 2


def test_previous_days(spark):
    got = spark.range(1).select(*previous_days(2, dt.date(2024, 5, 3))).collect()[0]
    assert tuple(got) == (at(0), at(0, 3))


DEFINITION = '{"flow_definition":{"output_dataset":"clean_events"}}'


def progress(total, *expectations):
    items = ",".join(
        f'{{"name":"{n}","dataset":"clean_events","passed_records":"{p}","failed_records":"{f}"}}' for n, p, f in expectations
    )
    return f'{{"flow_progress":{{"metrics":{{"num_output_rows":"{total}"}},"data_quality":{{"expectations":[{items}]}}}}}}'


@pytest.mark.parametrize("match_dataset", [False, True])
def test_outcomes(spark, pipelines, runs, match_dataset):
    log = spark.createDataFrame(
        [
            ("flow_definition", ("u1", "batch"), DEFINITION),
            ("flow_definition", ("u1", "batch"), DEFINITION),
            ("flow_progress", ("u1", "batch"), progress(4, ("user_id", 3, 1), ("country", 4, 0))),
            ("flow_progress", ("u1", "batch"), progress(2, ("user_id", 1, 1))),
            ("flow_progress", ("u1", "batch"), '{"flow_progress":{"status":"RUNNING"}}'),
            ("flow_progress", ("u3", "streaming"), progress(0, ("event_id", 0, 0))),
            ("flow_definition", ("u3", "streaming"), DEFINITION),
            ("other", ("u1", "batch"), '{"flow_definition":{"output_dataset":"not_a_flow"}}'),
        ],
        "event_type string, origin struct<request_id:string,pipeline_name:string>, details string",
    )
    got = rule_outcomes(pipelines, runs, log, None, START, END, match_dataset).drop("run_start_time", "run_end_time")
    assert rows(got) == [
        ("batch", "p1", "clean_events", "country", "4", "0", "4", Decimal("100.00"), "u1"),
        ("batch", "p1", "clean_events", "user_id", "3", "1", "4", Decimal("75.00"), "u1"),
        ("streaming", "p2", "clean_events", "event_id", "0", "0", "0", None, "u3"),
    ]
    assert rule_outcomes(pipelines, runs.limit(0), log, None, START, END).count() == 0


def test_cost(spark, pipelines, runs):
    schema = (
        "sku_name string, usage_date date, usage_start_time timestamp, usage_end_time timestamp, "
        "usage_quantity decimal(10,3), workspace_id string, usage_metadata struct<dlt_pipeline_id:string>, "
        "billing_origin_product string"
    )
    day = dt.date(2024, 5, 1)
    usage = spark.createDataFrame(
        [
            ("s", day, at(1), at(2), Decimal("1.500"), "w", ("p1",), "DLT"),
            ("s", day, at(1), at(2), Decimal("1.500"), "w", ("p1",), "DLT"),
            ("s", day, at(2), at(3), Decimal("9.000"), "w", ("p1",), "DLT"),
            ("s", day, at(1), at(2), Decimal("2.000"), "w", ("p1",), "JOBS"),
            ("s", day, at(23), at(0, 2), Decimal("2.000"), "w", ("p1",), "DLT"),
        ],
        schema,
    )
    prices = spark.createDataFrame([("s", (Decimal("0.333"),))], "sku_name string, pricing struct<default:decimal(10,3)>")
    got = run_cost(usage, pipelines, prices, runs, ["batch"], START, END)
    assert [(r.update_id, r.dbu_consumed, r.estimated_cost_usd) for r in got.collect()] == [
        ("u1", Decimal("1.500"), Decimal("0.50"))
    ]
    # A run that has not ended takes all usage since its start.
    open_run = runs.unionByName(
        spark.createDataFrame([("p1", "u9", None, "JOB", dt.datetime(2024, 4, 1), None)], runs.schema)
    )
    going = run_cost(usage, pipelines, prices, open_run, ["batch"], START, END).filter("update_id = 'u9'")
    assert sorted(str(r.dbu_consumed) for r in going.collect()) == ["1.500", "9.000"]
    every = run_cost(usage, pipelines, prices, runs, ["batch"], START, END, by_time=False)
    assert sorted((r.update_id, str(r.dbu_consumed)) for r in every.collect()) == sorted(
        (u, q) for u in ("u0", "u1", "u2") for q in ("1.500", "9.000")
    )


def test_a_run_that_ended_as_the_window_starts_costs_nothing(spark, pipelines):
    before = dt.datetime(2024, 4, 30, 23)
    runs = spark.createDataFrame(
        [("p1", "over", before, START), ("p1", "going", before, at(1)), ("p1", "instant", START, START)],
        "pipeline_id string, update_id string, period_start_time timestamp, period_end_time timestamp",
    )
    usage = spark.createDataFrame(
        [("s", dt.date(2024, 5, 1), START, at(1), Decimal("1.000"), "w", ("p1",), "DLT")],
        "sku_name string, usage_date date, usage_start_time timestamp, usage_end_time timestamp, "
        "usage_quantity decimal(10,3), workspace_id string, usage_metadata struct<dlt_pipeline_id:string>, "
        "billing_origin_product string",
    )
    prices = spark.createDataFrame([("s", (Decimal("2.000"),))], "sku_name string, pricing struct<default:decimal(10,3)>")
    got = run_cost(usage, pipelines, prices, runs, None, START, END)
    assert sorted(r.update_id for r in got.collect()) == ["going", "instant"]


def test_event_logs_are_found_by_name(spark, pipelines):
    log = spark.createDataFrame(
        [("flow_definition", ("u1", "batch"), DEFINITION)],
        "event_type string, origin struct<request_id:string,pipeline_name:string>, details string",
    )
    assert read_event_logs(spark, event_log_tables(pipelines, table_names(spark), ["batch"])) is None
    log.write.mode("overwrite").saveAsTable("event_log_p1")
    found = event_log_tables(pipelines, table_names(spark, prefix="event_log_"), None)
    assert rows(found) == [("p1", "batch", "default.`event_log_p1`")]
    assert read_event_logs(spark, found).count() == 1
    spark.sql("drop table event_log_p1")


def test_stored_health_is_unchanged_by_a_rerun(spark, pipelines, runs):
    target = f"health_{uuid.uuid4().hex[:8]}"
    for _ in range(2):
        store_monitor(run_health(pipelines, runs, None, START, END), "run_health", target)
    assert read_table(spark, target).count() == 2
    assert set(MONITOR_KEYS) == {"run_health", "rule_outcomes", "run_cost", "table_growth"}


def test_growth_of_tables(spark):
    name = f"growth_{uuid.uuid4().hex[:8]}"
    spark.range(100).repartition(3).write.saveAsTable(name)
    snapshot = at(6)

    def one():
        return table_growth(spark, [name], snapshot).collect()[0]

    got = one()
    assert (got.table_schema, got.table_name, got.num_rows, got.num_files) == ("default", name, 100, 3)
    assert got.size_bytes > 0 and got.size_mb == round(got.size_bytes / 1048576, 2) and got.snapshot_date == snapshot
    spark.sql(f"analyze table {name} compute statistics")
    assert one().num_rows == 100
    target = f"{name}_log"
    for mode in ("incremental", "incremental", "full"):
        store_monitor(table_growth(spark, [name], snapshot), "table_growth", target, mode)
        assert read_table(spark, target).count() == 1


def test_growth_of_folders(spark):
    got = folder_growth(spark, {"region": f"{SMALL}/region.parquet"}).collect()[0]
    assert (got.table_name, got.num_rows, got.num_files) == ("region", 5, 1)
    assert got.snapshot_date == got.last_modified


def test_growth_of_many_tables_is_a_few_jobs(spark, tmp_path):
    tag = uuid.uuid4().hex[:8]
    names = [f"many_{tag}_{i}" for i in range(40)]
    for i, name in enumerate(names[:-2]):
        spark.range(i).coalesce(1).write.saveAsTable(name)
    spark.range(7).selectExpr("id", "id % 2 as p").write.partitionBy("p").saveAsTable(names[-2])
    spark.range(9).write.format("json").saveAsTable(names[-1])
    spark.sql(f"analyze table {names[5]} compute statistics")
    sc = spark.sparkContext

    def grown(tables):
        """What is found, and the number of jobs that takes."""
        group = uuid.uuid4().hex
        sc.setJobGroup(group, "growth")
        try:
            found = {r.table_name: (r.num_rows, r.table_schema) for r in table_growth(spark, tables, at(6)).collect()}
            return found, len(sc.statusTracker().getJobIdsForGroup(group))
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)

    few, all_of = grown([*names[:6], names[-1]])[1], [*names[:-1], f"default.{names[-1]}"]
    found, many = grown(all_of)
    assert many <= few + 3  # two listings of more than 32 folders are jobs of their own
    assert found == {n: (i, "default") for i, n in enumerate(names[:-2])} | {names[-2]: (7, "default"), names[-1]: (9, "default")}
    with pytest.raises(LookupError):
        table_growth(spark, [f"none_{tag}"])


def test_a_file_belongs_to_the_innermost_folder(spark, tmp_path):
    outer, inner = f"{tmp_path}/a", f"{tmp_path}/a/b"
    spark.range(3).coalesce(1).write.parquet(inner)
    spark.range(5).coalesce(1).write.mode("append").parquet(f"{outer}/c")
    (tmp_path / "empty").mkdir()
    got = folder_growth(spark, {"outer": outer + "/", "inner": f"file://{inner}", "empty": f"{tmp_path}/empty"})
    assert {r.table_name: (r.num_rows, r.num_files) for r in got.collect()} == {"outer": (5, 1), "inner": (3, 1), "empty": (0, 0)}

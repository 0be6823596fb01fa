"""Registered monitor queries with their SQL twins.

Customers stand for pipelines, orders for their runs, order lines for usage and
for the reports in the event log, parts for the price list.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from eventmart.catalogue.tables import table
from eventmart.plans.monitors import folder_growth, rule_outcomes, run_cost, run_health

START, END = "1996-01-01 00:00:00", "1999-01-01 00:00:00"


def _between():
    return F.lit(START).cast("timestamp"), F.lit(END).cast("timestamp")


def _pipelines(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("pipeline_id"), F.col("c_name").alias("name"))


def _names(spark, sf):
    """The configured pipelines: customers of one segment."""
    return table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_name").alias("name"))


def _runs(spark, sf, length="1 day"):
    start = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("pipeline_id"),
        F.col("o_orderkey").alias("update_id"),
        F.col("o_orderstatus").alias("result_state"),
        F.col("o_orderpriority").alias("trigger_type"),
        start.alias("period_start_time"),
        (start + F.expr(f"interval {length}")).alias("period_end_time"),
    )


def _event_log(spark, sf):
    """Per order line one flow definition and one progress report, as JSON details."""
    # Both sides grow with the data; the shuffle also spreads the lines over all tasks.
    run = table(spark, sf, "orders").select("o_orderkey", "o_custkey").hint("shuffle_hash")
    pipeline = table(spark, sf, "customer").select("c_custkey", "c_name")
    lines = (
        table(spark, sf, "lineitem")
        .join(run, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(pipeline, F.col("o_custkey") == F.col("c_custkey"))
    )
    origin = F.struct(F.col("l_orderkey").alias("request_id"), F.col("c_name").alias("pipeline_name"))
    passed = F.col("l_quantity").cast("int")
    total = passed + F.col("l_linenumber") - 1
    definition = F.concat(F.lit('{"flow_definition":{"output_dataset":"set_'), "l_returnflag", F.lit('"}}'))
    progress = F.concat(
        F.lit('{"flow_progress":{"metrics":{"num_output_rows":"'),
        total.cast("string"),
        F.lit('"},"data_quality":{"expectations":[{"name":"rule_'),
        "l_linestatus",
        F.lit('","dataset":"set_'),
        "l_returnflag",
        F.lit('","passed_records":"'),
        passed.cast("string"),
        F.lit('","failed_records":"'),
        (total - passed).cast("string"),
        F.lit('"}]}}}'),
    )
    entries = F.array(
        F.struct(F.lit("flow_definition").alias("event_type"), definition.alias("details")),
        F.struct(F.lit("flow_progress").alias("event_type"), progress.alias("details")),
    )
    return lines.select(origin.alias("origin"), F.inline(entries))


RUNS_SQL = f"""
named as (select c_custkey as pipeline_id, c_name as pipeline_name from customer where c_mktsegment = 'BUILDING'),
runs as (
  select o_custkey as pipeline_id, o_orderkey as update_id, o_orderstatus as state, o_orderpriority as cause,
    o_orderdate as start_time, o_orderdate + interval {{length}} as end_time
  from orders)"""

REPORTS_SQL = """
log_lines as (
  select l_orderkey as update_id, concat('set_', l_returnflag) as dataset, concat('rule_', l_linestatus) as name,
    cast(l_quantity as int) as passed, l_linenumber - 1 as failed, cast(l_quantity as int) + l_linenumber - 1 as total
  from lineitem),
flows as (select distinct update_id, dataset as flow_name from log_lines)"""

OUTCOMES_SQL = f"""
select pipeline_name, pipeline_id, flow_name, name as expectations_name, cast(passed as varchar) as passed_records,
  cast(failed as varchar) as failed_records, cast(total as varchar) as total_rows,
  cast((200 * passed + total) // (2 * total) as decimal(19,2)) as pass_percentage,
  start_time as run_start_time, end_time as run_end_time, update_id
from reports join flows using (update_id) join runs using (update_id) join named using (pipeline_id)
where rn = 1 and start_time >= timestamp '{START}' and end_time <= timestamp '{END}'"""


def _usage(spark, sf):
    # Both sides grow with the data; the shuffle also spreads the lines over all tasks.
    run = table(spark, sf, "orders").select("o_orderkey", "o_custkey").hint("shuffle_hash")
    start = F.col("l_shipdate").cast("timestamp")
    return (
        table(spark, sf, "lineitem")
        .join(run, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("l_partkey").alias("sku_name"),
            F.to_date("l_shipdate").alias("usage_date"),
            start.alias("usage_start_time"),
            (start + F.make_dt_interval(hours=F.col("l_linenumber"))).alias("usage_end_time"),
            F.col("l_quantity").cast("decimal(10,2)").alias("usage_quantity"),
            F.col("l_suppkey").alias("workspace_id"),
            F.struct(F.col("o_custkey").alias("dlt_pipeline_id")).alias("usage_metadata"),
            F.when(F.col("l_returnflag") == "R", "JOBS").otherwise("DLT").alias("billing_origin_product"),
        )
    )


def _prices(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("sku_name"),
        F.struct(F.col("p_retailprice").cast("decimal(12,3)").alias("default")).alias("pricing"),
    )


def _growth(spark, sf):
    return folder_growth(
        spark, {t: f"{sf}/{t}.parquet" for t in ("customer", "orders", "lineitem", "events")}, _between()[1]
    )


QUERIES = {
    "run_health": (
        lambda spark, sf: run_health(_pipelines(spark, sf), _runs(spark, sf), _names(spark, sf), *_between()),
        f"""with {RUNS_SQL.format(length="1 day")}
select pipeline_id, pipeline_name, update_id, state, cause, start_time, end_time,
  cast(epoch(end_time) - epoch(start_time) as bigint) as duration_seconds
from runs join named using (pipeline_id)
where end_time < timestamp '{END}' and start_time >= timestamp '{START}'""",
    ),
    "rule_outcomes": (
        lambda spark, sf: rule_outcomes(
            _pipelines(spark, sf), _runs(spark, sf), _event_log(spark, sf), _names(spark, sf), *_between(), match_dataset=False
        ),
        f"""with {RUNS_SQL.format(length="1 day")}, {REPORTS_SQL},
reports as (
  select *, row_number() over (partition by update_id, name order by total desc, passed desc, failed desc) as rn
  from log_lines){OUTCOMES_SQL}""",
    ),
    "rule_outcomes_by_dataset": (
        lambda spark, sf: rule_outcomes(
            _pipelines(spark, sf), _runs(spark, sf), _event_log(spark, sf), None, *_between(), match_dataset=True
        ),
        f"""with {RUNS_SQL.format(length="1 day").replace("where c_mktsegment = 'BUILDING'", "")}, {REPORTS_SQL},
reports as (
  select * exclude (dataset), dataset as flow_name,
    row_number() over (partition by update_id, dataset, name order by total desc, passed desc, failed desc) as rn
  from log_lines){OUTCOMES_SQL.replace("join flows using (update_id)", "join flows using (update_id, flow_name)")}""",
    ),
    "run_cost": (
        lambda spark, sf: run_cost(
            _usage(spark, sf), _pipelines(spark, sf), _prices(spark, sf), _runs(spark, sf, "10 days"),
            _names(spark, sf), *_between(),
        ),
        f"""with {RUNS_SQL.format(length="10 days")},
usage as (
  select distinct o_custkey as pipeline_id, l_partkey as sku_name, cast(l_shipdate as date) as usage_date,
    l_shipdate as usage_start_time, l_shipdate + to_hours(l_linenumber) as usage_end_time,
    cast(l_quantity as decimal(10,2)) as dbu_consumed, l_suppkey as workspace_id
  from lineitem join orders on l_orderkey = o_orderkey where l_returnflag <> 'R')
select distinct pipeline_id, pipeline_name, update_id, sku_name, usage_date, usage_start_time, usage_end_time,
  dbu_consumed, cast(round(dbu_consumed * cast(p_retailprice as decimal(12,3)), 2) as decimal(21,2)) as estimated_cost_usd, workspace_id
from usage join named using (pipeline_id) join part on p_partkey = sku_name join runs using (pipeline_id)
where usage_start_time >= timestamp '{START}' and usage_end_time < timestamp '{END}'
  and usage_start_time < end_time and start_time < usage_end_time""",
    ),
    "table_growth": (lambda spark, sf: _growth(spark, sf), None),
    "table_growth_rows": (
        lambda spark, sf: _growth(spark, sf).select("table_name", "num_rows", "num_files", "snapshot_date"),
        " union all ".join(
            f"select '{t}' as table_name, count(*) as num_rows, cast(1 as bigint) as num_files, "
            f"timestamp '{END}' as snapshot_date from {t}"
            for t in ("customer", "orders", "lineitem", "events")
        ),
    ),
}

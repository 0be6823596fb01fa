"""Monitors: run health, rule outcomes, run cost and table growth.

Inputs are plain DataFrames with the columns named in each docstring. Names are
tested as a set, so one job covers all pipelines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventmart.operators.joins import interval_overlap_join
from eventmart.operators.ordering import top_per_group
from eventmart.session import ensure_checkpoint_dir
from eventmart.sources.catalog import folder_stats, footer_counts, many_table_details

# Event kinds of the pipeline event log and the parts of its JSON details.
FLOW_EVENTS = ["flow_progress", "flow_definition"]
FLOW_TYPE = "flow_definition struct<output_dataset:string>"
PROGRESS_TYPE = (
    "flow_progress struct<metrics:struct<num_output_rows:string>, data_quality:struct<expectations:"
    "array<struct<name:string,dataset:string,passed_records:string,failed_records:string>>>>"
)
BILLED_PRODUCT = "DLT"
LOG_PREFIX = "event_log_"


def _named(pipelines: DataFrame, names: DataFrame | Sequence[str] | None) -> DataFrame:
    picked = pipelines.select("pipeline_id", F.col("name").alias("pipeline_name"))
    if names is None:
        return picked
    if isinstance(names, DataFrame):
        return picked.join(names.select(F.col("name").alias("pipeline_name")), "pipeline_name", "left_semi")
    return picked.filter(F.col("pipeline_name").isin(list(names)))


def _at(moment) -> Column:
    return moment if isinstance(moment, Column) else F.lit(moment)


def previous_days(days: int = 1, today: dt.date | None = None) -> tuple[Column, Column]:
    """Start and end of the ``days`` calendar days before today, in local time."""
    day = F.current_date() if today is None else F.lit(today)
    return F.date_sub(day, days).cast("timestamp"), day.cast("timestamp")


def run_health(
    pipelines: DataFrame, runs: DataFrame, names: DataFrame | Sequence[str] | None, start, end
) -> DataFrame:
    """State and duration of the runs within [start, end).

    ``pipelines``: pipeline_id, name. ``runs``: pipeline_id, update_id,
    result_state, trigger_type, period_start_time, period_end_time. One row per
    run; of several rows of a run the latest stays.
    """
    inside = runs.filter(
        (F.col("period_end_time") < _at(end)) & (F.col("period_start_time") >= _at(start))
    )
    latest = top_per_group(
        inside,
        ["pipeline_id", "update_id"],
        [F.desc("period_end_time"), F.desc("period_start_time"), F.col("result_state"), F.col("trigger_type")],
    )
    return latest.join(_named(pipelines, names), "pipeline_id").select(
        "pipeline_id",
        "pipeline_name",
        "update_id",
        F.col("result_state").alias("state"),
        F.col("trigger_type").alias("cause"),
        F.col("period_start_time").alias("start_time"),
        F.col("period_end_time").alias("end_time"),
        (F.unix_timestamp("period_end_time") - F.unix_timestamp("period_start_time")).alias("duration_seconds"),
    )


def event_log_tables(
    pipelines: DataFrame, tables: DataFrame, names: DataFrame | Sequence[str] | None = None
) -> DataFrame:
    """The catalog tables that hold the event logs of the named pipelines.

    ``tables``: table_schema, table_name, as :func:`table_names` lists them.
    """
    logs = _named(pipelines, names).withColumn("table_name", F.concat(F.lit(LOG_PREFIX), "pipeline_id"))
    return tables.join(logs, "table_name").select(
        "pipeline_id",
        "pipeline_name",
        F.concat("table_schema", F.lit(".`"), "table_name", F.lit("`")).alias("full_name"),
    )


def read_event_logs(spark: SparkSession, found: DataFrame) -> DataFrame | None:
    """All listed event logs as one; None if there is none. The list is as short as the pipelines."""
    logs = [
        spark.table(r.full_name).select("event_type", "origin", "details")
        for r in found.select("full_name").distinct().collect()
    ]
    return reduce(DataFrame.unionByName, logs) if logs else None


def log_entries(event_log: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """One row per expectation and per flow an event of the log names; a flow's row has no expectation.

    ``runs`` (pipeline_name, update_id) cuts the log to these runs before its
    details are parsed, which happens once.
    """
    entries = event_log.select(
        F.col("origin.request_id").alias("update_id"), F.col("origin.pipeline_name").alias("pipeline_name"), "event_type", "details"
    )
    if runs is not None:
        entries = entries.join(runs.select("pipeline_name", "update_id"), ["pipeline_name", "update_id"], "left_semi")
    parsed = entries.select("update_id", "pipeline_name", "event_type", F.from_json("details", f"{FLOW_TYPE}, {PROGRESS_TYPE}").alias("d"))
    flow, progress = F.col("d.flow_definition.output_dataset"), F.col("d.flow_progress")
    text = F.lit(None).cast("string")
    counters = ("total_rows", "passed_records", "failed_records")
    flows = F.when(
        F.col("event_type").isin(FLOW_EVENTS) & flow.isNotNull(),
        F.array(F.struct(flow.alias("dataset"), text.alias("expectations_name"), *[text.alias(c) for c in counters])),
    )
    reports = F.transform(
        progress["data_quality"]["expectations"],
        lambda e: F.struct(
            e["dataset"].alias("dataset"), e["name"].alias("expectations_name"), progress["metrics"]["num_output_rows"].alias("total_rows"),
            e["passed_records"].alias("passed_records"), e["failed_records"].alias("failed_records"),
        ),
    )
    named = F.filter(reports, lambda e: e["expectations_name"].isNotNull())
    # Generated rows, so that filters on them do not repeat the parsing below.
    return parsed.select("update_id", "pipeline_name", F.inline(F.concat(F.coalesce(flows, F.array()), F.coalesce(named, F.array()))))


def _paired(entries: DataFrame, match_dataset: bool) -> DataFrame:
    """The report over most rows of each expectation, with the flow (or every flow of the run) it goes to.

    Entries are cut to one per (run, dataset, expectation) first; flows and
    reports then meet in a window over these few, so the log is read once.
    """
    run = ["pipeline_name", "update_id"]
    counters = ("total_rows", "passed_records", "failed_records")
    most = F.max(F.struct(*[F.expr(f"try_cast({c} as bigint)").alias(f"__{c}") for c in counters], *counters)).alias("report")
    is_flow = F.col("expectations_name").isNull()
    entries = entries.groupBy(*run, "dataset", "expectations_name").agg(most)
    if match_dataset:
        flows = F.max(is_flow).over(Window.partitionBy(*run, "dataset"))
        found = entries.withColumn("__flow", flows).filter(~is_flow & F.col("__flow")).withColumnRenamed("dataset", "flow_name")
    else:
        # A run has as many flows as its pipeline's code names.
        flows = F.collect_set(F.when(is_flow, F.col("dataset"))).over(Window.partitionBy(*run))
        reports = entries.withColumn("__flows", flows).filter(~is_flow).groupBy(*run, "expectations_name").agg(
            F.max("report").alias("report"), F.first("__flows").alias("__flows")
        )
        found = reports.withColumn("flow_name", F.explode("__flows"))
    return found.select(*run, "flow_name", "expectations_name", *[F.col("report")[c].alias(c) for c in counters])


def rule_outcomes(
    pipelines: DataFrame,
    runs: DataFrame,
    event_log: DataFrame,
    names: DataFrame | Sequence[str] | None,
    start,
    end,
    match_dataset: bool = True,
) -> DataFrame:
    """Passed and failed records per (run, flow, expectation) within [start, end].

    A flow is paired with the expectations on its own dataset; without
    ``match_dataset`` with every expectation of its run. Of several
    reports the one over most rows stays. The share is null when no row was
    written. The log is cut to the wanted runs, then read and parsed once.
    """
    inside = (
        runs.filter((F.col("period_start_time") >= _at(start)) & (F.col("period_end_time") <= _at(end)))
        .select(
            "pipeline_id",
            "update_id",
            F.col("period_start_time").alias("run_start_time"),
            F.col("period_end_time").alias("run_end_time"),
        )
        .join(_named(pipelines, names), "pipeline_id")
    )
    found = _paired(log_entries(event_log, inside), match_dataset)
    share = F.try_divide(
        F.expr("try_cast(passed_records as bigint)") * F.lit(1.0).cast("decimal(2,1)"),
        F.expr("try_cast(total_rows as bigint)"),
    )
    # One row per pipeline and run; a run may be listed for several pipelines of a name.
    latest = top_per_group(inside, ["pipeline_id", "update_id"], [F.desc("run_end_time"), F.desc("run_start_time")])
    return found.join(latest, ["pipeline_name", "update_id"]).select(
        "pipeline_name",
        "pipeline_id",
        "flow_name",
        "expectations_name",
        "passed_records",
        "failed_records",
        "total_rows",
        (F.round(share, 2) * 100).alias("pass_percentage"),
        "run_start_time",
        "run_end_time",
        "update_id",
    )


def run_cost(
    usage: DataFrame,
    pipelines: DataFrame,
    prices: DataFrame,
    runs: DataFrame,
    names: DataFrame | Sequence[str] | None,
    start,
    end,
    by_time: bool = True,
) -> DataFrame:
    """Usage and list price per run.

    ``usage``: sku_name, usage_date, usage_start_time, usage_end_time,
    usage_quantity, workspace_id, usage_metadata.dlt_pipeline_id,
    billing_origin_product. ``prices``: sku_name, pricing.default. A usage row
    goes to the runs it overlaps in time. With ``by_time`` false it goes to
    every run of its pipeline, whenever that was.
    """
    billed = (
        usage.filter(
            (F.col("billing_origin_product") == BILLED_PRODUCT)
            & (F.col("usage_start_time") >= _at(start))
            & (F.col("usage_end_time") < _at(end))
        )
        .select(
            F.col("usage_metadata.dlt_pipeline_id").alias("pipeline_id"),
            "sku_name",
            "usage_date",
            "usage_start_time",
            "usage_end_time",
            F.col("usage_quantity").alias("dbu_consumed"),
            "workspace_id",
        )
        # Equal usage rows end up as one, so drop repeats before anything multiplies them.
        .distinct()
        .join(_named(pipelines, names), "pipeline_id")
        .join(prices.select("sku_name", F.col("pricing.default").alias("price")).distinct(), "sku_name")
    )
    if by_time:
        # A run without an end is still going. Runs are cut to the window, so a
        # long one is laid out over the window's days only. One that ended just
        # as the window starts has no part in it; cut, it would be an instant.
        first, last = _at(start).cast("timestamp"), _at(end).cast("timestamp")
        until = F.coalesce("period_end_time", last)
        inside = (until > first) | ((until == first) & (F.col("period_start_time") >= first))
        spans = (
            runs.filter((F.col("period_start_time") < last) & inside)
            .select(
                "pipeline_id",
                "update_id",
                F.greatest("period_start_time", first).alias("run_from"),
                F.least(until, last).alias("run_to"),
            )
            .distinct()
        )
        matched = interval_overlap_join(
            billed, spans, ["pipeline_id"], ("usage_start_time", "usage_end_time"), ("run_from", "run_to")
        )
    else:
        matched = billed.join(runs.select("pipeline_id", "update_id").distinct(), "pipeline_id")
    return matched.select(
        "pipeline_id",
        "pipeline_name",
        "update_id",
        "sku_name",
        "usage_date",
        "usage_start_time",
        "usage_end_time",
        "dbu_consumed",
        F.round(F.col("dbu_consumed") * F.col("price"), 2).alias("estimated_cost_usd"),
        "workspace_id",
    ).distinct()


def _growth(stats: DataFrame, snapshot) -> DataFrame:
    return stats.select(
        "table_catalog",
        "table_schema",
        "table_name",
        F.col("num_rows").cast("long").alias("num_rows"),
        "num_files",
        "size_bytes",
        F.round(F.col("size_bytes") / F.lit(1024 * 1024), 2).alias("size_mb"),
        "last_modified",
        (F.col("created_at") if snapshot is None else _at(snapshot).cast("timestamp")).alias("snapshot_date"),
    )


def folder_growth(spark: SparkSession, folders: dict[str, str], snapshot=None) -> DataFrame:
    """Rows, files, bytes and times of Parquet folders or files, by the given names.

    One listing and one count of all; row counts come from the file footers.
    """
    found = folder_stats(spark, folders).join(footer_counts(spark, folders), "name")
    none = F.lit(None).cast("string")
    return _growth(found.withColumns({"table_catalog": none, "table_schema": none, "table_name": F.col("name")}), snapshot)


def table_growth(spark: SparkSession, tables: Sequence[str], snapshot=None) -> DataFrame:
    """The same for catalog tables; row counts come from their statistics if these are there.

    One catalog command per database, one listing and one count for all tables;
    the tables' names and places come to the driver, a row each.
    """
    found = many_table_details(spark, tables).withColumn("known", F.regexp_extract("statistics", r"(\d+) rows", 1))
    ensure_checkpoint_dir(spark)
    found = found.withColumn("known", F.expr("try_cast(known as bigint)")).checkpoint()
    rows = found.select("name", "location", "provider", "known").collect()
    missing = set(tables) - {r["name"] for r in rows}
    if missing:
        raise LookupError(f"no such tables: {sorted(missing)}")
    stats = folder_stats(spark, {r["name"]: r["location"] for r in rows})
    joined = found.join(stats, "name")
    counted = [r for r in rows if r["known"] is None]
    parquet = {r["name"]: r["location"] for r in counted if (r["provider"] or "").lower() == "parquet"}
    counts = [footer_counts(spark, parquet)] if parquet else []
    counts += [
        spark.table(r["name"]).agg(F.lit(r["name"]).alias("name"), F.count("*").alias("num_rows")).select("name", "num_rows")
        for r in counted
        if r["name"] not in parquet
    ]
    if counts:
        joined = joined.join(reduce(DataFrame.unionByName, counts), "name", "left").withColumn("num_rows", F.coalesce("known", "num_rows"))
    else:
        joined = joined.withColumn("num_rows", F.col("known"))
    return _growth(joined, snapshot)

"""Data-quality rules read from a rule table and applied to any DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventmart.operators.joins import all_of
from eventmart.operators.project import typed_select

ACTIONS = ("warn", "drop", "fail")


@dataclass(frozen=True)
class Rule:
    rule_id: str
    field: str
    predicate: str
    action: str

    def passes(self) -> Column:
        """True or false; an unknown predicate value counts as failed."""
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def load_rules(
    rules: DataFrame, entity: str, as_of: dt.date | None = None, action: str | None = None
) -> list[Rule]:
    """Active rules of an entity that are in effect on ``as_of`` (default today).

    The rule table is configuration: the few matching rows come to the driver.
    """
    day = F.current_date() if as_of is None else F.lit(as_of)
    wanted = rules.filter(
        (F.col("entity") == entity)
        & F.col("is_active")
        & (F.col("effective_from").isNull() | (F.col("effective_from") <= day))
        & (F.col("effective_to").isNull() | (F.col("effective_to") >= day))
    )
    if action is not None:
        wanted = wanted.filter(F.col("action_type") == action)
    rows = wanted.select("rule_id", "field_name", "rule_expression", "action_type").collect()
    return sorted(
        (Rule(*row) for row in rows), key=lambda r: (ACTIONS.index(r.action), r.field, r.rule_id)
    )


def _of(rules: Sequence[Rule], action: str) -> list[Rule]:
    return [r for r in rules if r.action == action]


def expect_drop(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Keeps the rows that pass every drop rule."""
    chosen = _of(rules, "drop")
    return df.filter(all_of([r.passes() for r in chosen])) if chosen else df


def expect_fail(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Stops the job on the first row that breaks a fail rule; works in streams too."""
    for rule in _of(rules, "fail"):
        message = F.lit(f"rule {rule.rule_id} on {rule.field} failed: {rule.predicate}")
        df = df.filter(F.when(rule.passes(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    return df


def expect_warn(df: DataFrame, rules: Sequence[Rule], observation: Observation | str | None = None) -> DataFrame:
    """Keeps all rows; counts failures per warn and drop rule through ``observation`` if given."""
    chosen = _of(rules, "warn") + _of(rules, "drop")
    if not chosen or observation is None:
        return df
    counters = [F.count(F.lit(1)).alias("total_records")]
    counters += [F.count_if(~r.passes()).alias(f"failed_{r.rule_id}") for r in chosen]
    return df.observe(observation, *counters)


def expect(df: DataFrame, rules: Sequence[Rule], observation: Observation | str | None = None) -> DataFrame:
    """All three actions: fail first, then count on what came in, then drop."""
    return expect_drop(expect_warn(expect_fail(df, rules), rules, observation), rules)


def accepted(df: DataFrame) -> DataFrame:
    """Rows whose landing record fitted the schema."""
    return df.filter(F.col("_rescued_data").isNull())


def rejected(df: DataFrame) -> DataFrame:
    """The complement of :func:`accepted`, for a quarantine output."""
    return df.filter(F.col("_rescued_data").isNotNull())


def clean(
    df: DataFrame,
    schema: StructType,
    rules: Sequence[Rule],
    observation: Observation | str | None = None,
) -> DataFrame:
    """Bronze to silver: refuse rescued rows, type the columns, apply the rules. No shuffle."""
    return expect(typed_select(accepted(df), schema), rules, observation)


def rule_metrics(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Passed, failed and total rows per rule. One aggregate over one scan, then unpivoted."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(r.passes()).alias(f"p{i}") for i, r in enumerate(rules)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(r.rule_id).alias("rule_id"),
                F.lit(r.field).alias("field_name"),
                F.lit(r.action).alias("action_type"),
                F.col(f"p{i}").alias("passed_records"),
                (F.col("total") - F.col(f"p{i}")).alias("failed_records"),
                F.col("total").alias("total_records"),
            )
            for i, r in enumerate(rules)
        ]
    )
    percent = F.round(F.try_divide("passed_records", "total_records"), 2) * 100
    return counts.select(F.inline(rows)).withColumn("pass_percentage", percent)


COUNTERS_SCHEMA = (
    "stream string, batch_id bigint, update_id string, rule_id string, field_name string, action_type string, "
    "passed_records bigint, failed_records bigint, total_records bigint"
)


def store_counters(df: DataFrame, rules: Sequence[Rule], folder: str, stream: str, batch_id: int, update_id: str = "") -> None:
    """Keeps one batch's counters of all rules, warn, drop and fail, on the rows as they came in.

    The folder is partitioned by (stream, batch); a batch that comes again
    replaces its own counters and nothing else. ``update_id`` names the run.
    """
    named = {"stream": F.lit(stream), "batch_id": F.lit(batch_id).cast("bigint"), "update_id": F.lit(update_id)}
    found = rule_metrics(df, rules).withColumns(named).select(*[c.split()[0] for c in COUNTERS_SCHEMA.split(", ")])
    writer = found.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("stream", "batch_id").parquet(folder)


def read_counters(spark: SparkSession, folder: str) -> DataFrame:
    """All counters kept in a folder, in the order of ``COUNTERS_SCHEMA``."""
    return spark.read.schema(COUNTERS_SCHEMA).parquet(folder).select(*[c.split()[0] for c in COUNTERS_SCHEMA.split(", ")])


def counter_events(counters: DataFrame, pipeline_name: str) -> DataFrame:
    """The counters as event-log rows, summed over the batches of a run: what the rule monitor reads."""
    sums = [F.sum(c).cast("string").alias(c) for c in ("passed_records", "failed_records", "total_records")]
    runs = counters.groupBy("stream", "update_id", "rule_id").agg(*sums)
    report = F.struct(F.col("rule_id").alias("name"), F.col("stream").alias("dataset"), "passed_records", "failed_records")
    progress = F.struct(
        F.struct(F.col("total_records").alias("num_output_rows")).alias("metrics"),
        F.struct(F.array(report).alias("expectations")).alias("data_quality"),
    )
    definition = F.struct(F.struct(F.col("stream").alias("output_dataset")).alias("flow_definition"))
    entries = F.array(
        F.struct(F.lit("flow_definition").alias("event_type"), F.to_json(definition).alias("details")),
        F.struct(F.lit("flow_progress").alias("event_type"), F.to_json(F.struct(progress.alias("flow_progress"))).alias("details")),
    )
    origin = F.struct(F.col("update_id").alias("request_id"), F.lit(pipeline_name).alias("pipeline_name"))
    return runs.select(origin.alias("origin"), F.inline(entries)).select("event_type", "origin", "details")

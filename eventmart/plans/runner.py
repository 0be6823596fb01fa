"""Incremental refresh of the marts in catalog tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.operators.history import BUCKET, BUCKETS, current_rows, with_bucket
from eventmart.operators.incremental import (
    LATE,
    WATERMARK_SCHEMA,
    affected_keys,
    in_days,
    incremental_slice,
    of_keys,
    touched_days,
    watermark_value,
)
from eventmart.operators.joins import broadcast_if_small, null_safe_join
from eventmart.operators.merge import delete_where, replace_keys
from eventmart.plans import ads as ad_plans
from eventmart.plans import anomalies, content, hourly, sessions
from eventmart.session import ensure_checkpoint_dir
from eventmart.sources.catalog import (
    delete_matches,
    delete_rows,
    drop_table,
    keep_buckets,
    read_table,
    replace_table,
    rewrite_partitions,
    table_exists,
    upsert_table,
)


# Day column of stored partial rows, and suffix of their table.
DAY = "event_day"
PARTIALS = "__partials"


@dataclass(frozen=True)
class Mart:
    """How a mart is built, and which of its rows a slice of the sources touches."""

    build: Callable[..., DataFrame]
    # Columns of the (prepared) sources; their touched values are built again.
    slice_keys: Sequence[str]
    # Adds the slice keys to a source when they are computed.
    prepare: Callable[[DataFrame], DataFrame] = field(default=lambda df: df)
    # Turns touched slice keys into key columns of the mart when these differ.
    label: Callable[[DataFrame], DataFrame] = field(default=lambda touched: touched)
    # Leaves out source rows of other days than the touched keys', so that files are skipped.
    prune: Callable[[DataFrame, DataFrame], DataFrame] = field(default=lambda source, touched: source)
    # Mergeable rows of the first source, per the given columns and the partials' own keys ...
    partial: Callable[..., DataFrame] | None = None
    # ... and the mart made of them and the other sources; with both, a refresh reads the slice's days only.
    fold: Callable[..., DataFrame] | None = None
    # Partition column of the stored mart; by default a hash bucket of the slice keys.
    partition: str = BUCKET
    # Column that says when a row was found: equal rows keep the value they had.
    stamp: str | None = None
    # Runs over the whole merged mart, which is then stored unpartitioned.
    finish: Callable[[DataFrame], DataFrame] | None = None


def _with_hour(events: DataFrame) -> DataFrame:
    return events.withColumns({"__day": F.to_date("timestamp"), "__hour": F.hour("timestamp")})


def _hour_texts(touched: DataFrame) -> DataFrame:
    return touched.select(
        F.date_format("__day", "yyyy-MM-dd").alias("date"), F.lpad(F.col("__hour").cast("string"), 2, "0").alias("hour")
    )


def _on_touched_days(events: DataFrame, touched: DataFrame) -> DataFrame:
    return in_days(events, touched_days(touched, "__day"))


def hourly_mart() -> Mart:
    return Mart(
        hourly.hourly_active_users,
        ["__day", "__hour"],
        prepare=_with_hour,
        label=_hour_texts,
        prune=_on_touched_days,
        partition="date",
    )


def session_mart() -> Mart:
    return Mart(sessions.user_session_summary, ["user_id"], partial=sessions.session_partials, fold=sessions.fold_sessions)


def content_mart() -> Mart:
    # Ranks of untouched content move too, so the whole mart is ranked again.
    return Mart(
        content.content_engagement,
        content.KEYS,
        finish=content.rank_content,
        partial=content.content_partials,
        fold=content.fold_content,
    )


def _current(source: DataFrame) -> DataFrame:
    return current_rows(source) if "valid_to" in source.columns else source


def ad_mart() -> Mart:
    # Of a type-2 history of ads the open versions count: one row per ad.
    return Mart(ad_plans.ad_performance, ["ad_id"], prepare=_current, partial=ad_plans.ad_partials, fold=ad_plans.fold_ads)


def anomaly_mart(bucket: str = "minute", country_gap: str | None = None, **options) -> Mart:
    # Running addresses and changes of country depend on a user's whole history, of which the partials are enough.
    grain = {"bucket": bucket, "country_gap": country_gap}
    return Mart(
        lambda events: anomalies.anomaly_flags(events, **grain, **options),
        ["user_id"],
        stamp="detection_timestamp",
        partial=lambda events, *by: anomalies.anomaly_partials(events, *by, **grain),
        fold=lambda partials: anomalies.fold_flags(partials, **grain, **options),
    )


def touched_keys(mart: Mart, sources: Sequence[DataFrame], watermark, late: str = LATE) -> DataFrame:
    """Slice keys with a row past the watermark in any source; one watermark for all, or a list with one for each."""
    marks = watermark if isinstance(watermark, (list, tuple)) else [watermark] * len(sources)
    slices = [incremental_slice(mart.prepare(s), mark, late=late) for s, mark in zip(sources, marks, strict=True)]
    return affected_keys(slices, mart.slice_keys)


def day_partials(mart: Mart, events: DataFrame) -> DataFrame:
    """The mart's partial rows per local day of the events."""
    return mart.partial(mart.prepare(events).withColumn(DAY, F.to_date("timestamp")), DAY)


def refresh_partials(mart: Mart, partials: DataFrame, events: DataFrame, days: Sequence[dt.date | None]) -> DataFrame:
    """The partial rows with those of the given days made again from the events of these days."""
    known = [d for d in days if d is not None]
    of_days = F.col(DAY).isin(known) if known else F.lit(False)
    if None in days:
        of_days = of_days | F.col(DAY).isNull()
    kept = delete_where(partials, of_days)
    return kept.unionByName(day_partials(mart, in_days(events, days)).select(*partials.columns))


def refresh_rows(
    mart: Mart, target: DataFrame, sources: Sequence[DataFrame], touched: DataFrame, partials: DataFrame | None = None
) -> DataFrame:
    """The mart with the rows of the touched keys built again from their whole history.

    With the mart's ``partials``, already brought up to date, their history is
    read from these and the first source is not. Totals do not shrink to the
    slice, and a repeated run changes nothing. ``mart.finish`` is still to be
    run.
    """
    first = [mart.prepare(sources[0])] if partials is None else [partials]
    history = [of_keys(s, touched, mart.slice_keys) for s in [*first, *(mart.prepare(s) for s in sources[1:])]]
    labels, built = mart.label(touched), (mart.build if partials is None else mart.fold)(*history)
    if mart.stamp:
        grain = [c for c in built.columns if c != mart.stamp]
        known = target.groupBy(*grain).agg(F.min(mart.stamp).alias("__stamp"))
        built = null_safe_join(built, known, grain, "left").withColumn(mart.stamp, F.coalesce("__stamp", mart.stamp)).drop("__stamp")
    return replace_keys(target, built.select(*target.columns), labels, labels.columns)


def _placed(df: DataFrame, mart: Mart, buckets: int) -> DataFrame:
    """Adds the bucket column if the mart is stored by bucket."""
    return with_bucket(df, mart.slice_keys, buckets) if mart.partition == BUCKET else df


def read_mart(spark: SparkSession, table: str) -> DataFrame:
    """A stored mart without its bucket column."""
    return read_table(spark, table).drop(BUCKET)


def _in_few_files(df: DataFrame, partition: str) -> DataFrame:
    """Rows of a partition meet in tasks of about the advised size, so that it is a few files, however large it is."""
    return df.hint("rebalance", partition)


def partials_table(table: str) -> str:
    """Name of the table that holds a mart's partial rows, partitioned by day."""
    return f"{table}{PARTIALS}"


def _first_build(mart: Mart, sources: Sequence[DataFrame], table: str, buckets: int) -> None:
    spark = sources[0].sparkSession
    if mart.partial:
        stored = partials_table(table)
        replace_table(_in_few_files(day_partials(mart, sources[0]), DAY), stored, [DAY])
        rows = mart.fold(read_table(spark, stored), *[mart.prepare(s) for s in sources[1:]])
    else:
        rows = mart.build(*[mart.prepare(s) for s in sources])
    if mart.finish:
        replace_table(rows, table)
    else:
        replace_table(_in_few_files(_placed(rows, mart, buckets), mart.partition), table, [mart.partition])


def _refresh_partials(mart: Mart, events: DataFrame, table: str, days: Sequence[dt.date | None]) -> DataFrame:
    """Makes the stored partial rows of the given days again; running it twice changes nothing."""
    spark, stored = events.sparkSession, partials_table(table)
    if days:
        used = spark.createDataFrame([(d,) for d in days], f"{DAY} date")
        rewrite_partitions(_in_few_files(day_partials(mart, in_days(events, days)), DAY), stored, used)
    return read_table(spark, stored)


def _refresh(
    mart: Mart,
    sources: Sequence[DataFrame],
    table: str,
    touched: DataFrame,
    buckets: int,
    days: Sequence[dt.date | None] = (),
) -> None:
    spark = touched.sparkSession
    partials = _refresh_partials(mart, sources[0], table, days) if mart.partial else None
    history = [mart.prune(s, touched) for s in sources]
    if mart.finish:
        old = read_table(spark, table)
        merged = refresh_rows(mart, old, history, touched, partials).checkpoint()
        replace_table(mart.finish(merged).select(*old.columns), table)
        return
    # At most one row per bucket or day: small, and Spark prunes the stored mart by it.
    used = _placed(mart.label(touched), mart, buckets).select(mart.partition).distinct()
    old = null_safe_join(read_table(spark, table), F.broadcast(used), [mart.partition], "left_semi")
    merged = refresh_rows(mart, old.drop(BUCKET), history, touched, partials)
    rewrite_partitions(_in_few_files(_placed(merged, mart, buckets), mart.partition), table, used)


def run_mart(
    spark: SparkSession,
    name: str,
    mart: Mart,
    source_tables: Sequence[str],
    target_table: str,
    watermark_table: str,
    refresh: str = "incremental",
    late: str = LATE,
    buckets: int = BUCKETS,
) -> None:
    """Brings a mart table up to date and moves its watermarks.

    Only partitions with a touched key are read and rewritten. A mart with
    partials has them in a table beside it: of the first source the slice is
    read, and the days with rows in it, and no more. ``refresh="full"`` drops
    the mart, its partials and its watermarks first. Every source has its own, so one
    that lags the others loses nothing: the first goes by the mart's name, the
    others by name and table. A new watermark is the greatest ``updated_at`` of
    the source's slice, read before the rows are, so later arrivals fall into
    the next slice. ``buckets`` is stored with the mart; another number fails.
    """
    if refresh not in ("incremental", "full"):
        raise ValueError("refresh is 'incremental' or 'full'")
    entities = [name, *(f"{name}:{t}" for t in source_tables[1:])]
    if refresh == "full":
        drop_table(spark, target_table)
        drop_table(spark, partials_table(target_table))
        if table_exists(spark, watermark_table):
            delete_rows(spark, watermark_table, F.col("entity_name").isin(entities))
    known = table_exists(spark, watermark_table)
    marks = [watermark_value(read_table(spark, watermark_table), e) if known else None for e in entities]
    sources = [read_table(spark, t) for t in source_tables]
    # Within the slice, so that files without new rows are skipped.
    newest = [incremental_slice(s, m, late=late).agg(F.max("updated_at")).take(1)[0][0] for s, m in zip(sources, marks)]
    reached = [max((t for t in pair if t is not None), default=None) for pair in zip(newest, marks)]

    bucketed = mart.partition == BUCKET and not mart.finish
    complete = table_exists(spark, target_table) and (not mart.partial or table_exists(spark, partials_table(target_table)))
    if all(m is None for m in marks) or not complete:
        _first_build(mart, sources, target_table, buckets)
        if bucketed:
            keep_buckets(spark, target_table, buckets)
    else:
        if bucketed:
            keep_buckets(spark, target_table, buckets)
        # Used several times; stored once, and sent to all tasks only if small.
        ensure_checkpoint_dir(spark)
        touched = touched_keys(mart, sources, marks, late).checkpoint()
        if touched.take(1):
            days = touched_days(incremental_slice(sources[0], marks[0], late=late)) if mart.partial else []
            _refresh(mart, sources, target_table, broadcast_if_small(touched), buckets, days)
    moved = [(e, r) for e, r, m in zip(entities, reached, marks) if r != m]
    if moved:
        upsert_table(spark.createDataFrame(moved, WATERMARK_SCHEMA), watermark_table, ["entity_name"])


COST_MEASURES = ("dbu_consumed", "estimated_cost_usd")
# Grain of the stored monitors.
MONITOR_KEYS = {
    "run_health": ["pipeline_id", "update_id"],
    "rule_outcomes": ["pipeline_id", "update_id", "flow_name", "expectations_name"],
    "run_cost": ["pipeline_id", "update_id", "sku_name", "usage_start_time", "usage_end_time", "workspace_id"],
    "table_growth": ["table_catalog", "table_schema", "table_name", "snapshot_date"],
}


def store_monitor(rows: DataFrame, monitor: str, table: str, refresh: str = "incremental") -> None:
    """Merges a monitor's rows into its table; ``refresh="full"`` starts the table anew."""
    if refresh == "full":
        drop_table(rows.sparkSession, table)
    keys = MONITOR_KEYS[monitor]
    if monitor == "run_cost":
        # Measures are no keys, so that a corrected price replaces its row; usage rows of one key are added up.
        others = [F.first(c, ignorenulls=True).alias(c) for c in rows.columns if c not in (*keys, *COST_MEASURES)]
        sums = [F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in COST_MEASURES]
        rows = rows.groupBy(*keys).agg(*others, *sums).select(*rows.columns)
    upsert_table(rows, table, keys, null_safe=True)


def erase_from_tables(spark: SparkSession, tables: Sequence[tuple[str, str]], subjects: DataFrame, key: str) -> None:
    """Takes the subjects' rows out of each (table, subject column), in the order given.

    Partitions without such a row keep their files. List a mart's table of
    partials too, if it has one by subject.
    """
    ensure_checkpoint_dir(spark)
    gone = broadcast_if_small(subjects.select(key).distinct().checkpoint())
    for table, column in tables:
        delete_matches(spark, table, gone, column, key)

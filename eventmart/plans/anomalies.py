"""Suspicious activity per user and time bucket.

Three signs are checked: many events in a bucket (spike), many addresses so far
(bot), and a country that differs from the user's previous event (suspicious).
All work is done on aggregates of (user, bucket); events are never joined back.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from eventmart.operators.joins import null_safe_join
from eventmart.operators.ordering import (
    HOT_ROWS,
    drop_chunks,
    neighbour,
    new_values,
    split_hot,
)

# Texts of the buckets and the flags.
BUCKET_FORMATS = {"minute": "yyyy-MM-dd HH:mm", "hour": "yyyy-MM-dd HH", "day": "yyyy-MM-dd"}
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
FLAG_NAMES = {"spike": "spike", "suspicious": "suspicious", "bot": "bot"}
FLAG_REASONS = {
    "spike": "unusual network traffic observed",
    "suspicious": "multiple different geo location login detected",
    "bot": "multiple IP with same user-id",
}
NO_FLAG = "normal"
# Code by (spike + 2 * suspicious + 4 * bot), and severity by code.
CASE_CODES = [0, 1, 2, 4, 3, 5, 6, 7]
SEVERITIES = ["NA", "low", "low", "medium", "medium", "high", "high", "high"]


def _bucketed(events: DataFrame, bucket: str) -> DataFrame:
    """Adds the bucket start in local wall-clock time."""
    local = F.col("timestamp").cast("timestamp_ntz").cast("timestamp")
    return events.withColumn("bucket", F.date_trunc(bucket, local))


def events_per_bucket(events: DataFrame, bucket: str = "minute", by: Sequence[str] = ()) -> DataFrame:
    """Distinct events and the first and last time per (``by``, user, bucket)."""
    return (
        _bucketed(events, bucket)
        .groupBy(*by, "user_id", "bucket")
        .agg(
            F.count_distinct("event_id").alias("number_of_events"),
            F.min("timestamp").alias("first_ts"),
            F.max("timestamp").alias("last_ts"),
        )
    )


def _changed(previous: Column, country: Column, timestamp: Column, country_gap: str | None) -> Column:
    """Whether a step's country differs from that of the step before it, by less than ``country_gap``."""
    change = previous["country"] != country
    if country_gap is not None:
        change = change & (timestamp < previous["timestamp"] + F.expr(f"interval {country_gap}"))
    return F.coalesce(change, F.lit(False))


def country_steps(events: DataFrame, country_gap: str | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per (user, time, country): its events and whether it is a change of country.

    Events are ordered by time, then country. Events of one time and country are
    neighbours in that order, so they are counted before the ordering and only
    the first of them can be a change. ``country_gap`` also asks the previous
    event to be less than that long ago.
    """
    steps = events.groupBy("user_id", "timestamp", "country").agg(F.count("*").alias("n_events"))
    order = ["timestamp", "country"]
    parts = split_hot(steps, ["user_id"], order, hot_rows, counted=events)
    found = reduce(DataFrame.unionByName, [drop_chunks(neighbour(p, order, F.struct("country", "timestamp"), "previous")) for p in parts])
    previous = F.col("previous")
    return found.select(
        "user_id",
        "timestamp",
        "country",
        "n_events",
        previous["country"].alias("prev_country"),
        previous["timestamp"].alias("prev_timestamp"),
        _changed(previous, F.col("country"), F.col("timestamp"), country_gap).alias("suspicious"),
    )


def _seen(events: DataFrame, bucket: str, by: Sequence[str]) -> DataFrame:
    """Events counted by time, country and address, dealt over tasks by (user, minute).

    All further work inside a minute needs no other shuffle, and the readers of
    this plan share one scan of the events: ``signed`` is the count, negative
    without an address, so that asking for addresses is a filter above the
    shuffle and both readers have the same plan below it.
    """
    minute = F.date_trunc("minute", F.col("timestamp").cast("timestamp_ntz").cast("timestamp"))
    return (
        _bucketed(events, bucket)
        .withColumn("minute", minute)
        .select(*by, "user_id", "bucket", "minute", "timestamp", "country", "ip_address")
        .repartition("user_id", "minute")
        .groupBy(*by, "user_id", "bucket", "minute", "timestamp", "country", "ip_address")
        .agg(F.sum(F.when(F.col("ip_address").isNull(), -1).otherwise(1)).alias("signed"))
    )


def _carried(parts: DataFrame, along: WindowSpec, country_gap: str | None) -> DataFrame:
    """Edge summaries in which the first step is compared with the last step of the summary before it."""
    before, first = F.lag("last_edge").over(along), F.col("first_edge")
    changed = _changed(F.col("__before"), first["country"], first["timestamp"], country_gap)
    at = F.when(F.col("__changed"), first["timestamp"])
    return (
        parts.withColumn("__before", before)
        .withColumn("__changed", changed)
        .withColumns(
            {
                "changes": F.col("changes") + F.col("__changed").cast("long"),
                "first_change": F.least("first_change", at),
                "last_change": F.greatest("last_change", at),
            }
        )
        .drop("__before", "__changed")
    )


def _folded(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One edge summary per key out of the carried ones of its parts."""
    return parts.groupBy(*keys).agg(
        F.min("first_edge").alias("first_edge"),
        F.max("last_edge").alias("last_edge"),
        F.sum("n_events").alias("n_events"),
        F.sum("changes").alias("changes"),
        F.min("first_change").alias("first_change"),
        F.max("last_change").alias("last_change"),
    )


def edge_summaries(
    events: DataFrame, bucket: str = "minute", country_gap: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Per (``by``, user, bucket): its first and last step, its events, and the changes of country inside it.

    Steps are times and countries in that order. The summaries are associative:
    those of neighbouring stretches of time make the one of both, with one
    comparison of the last step of the first and the first step of the second.
    So only a minute's steps are ever sorted, and coarser buckets are made of
    minutes.
    """
    keys = [*by, "user_id", "bucket"]
    steps = _seen(events, bucket, by).groupBy(*keys, "minute", "timestamp", "country").agg(F.sum(F.abs("signed")).alias("n_events"))
    edge = F.struct("timestamp", "country")
    inside = Window.partitionBy("user_id", "minute").orderBy("timestamp", "country")
    found = _changed(F.col("__before"), F.col("country"), F.col("timestamp"), country_gap)
    at = F.when(F.col("__changed"), F.col("timestamp"))
    single = (
        steps.withColumn("__before", F.lag(edge).over(inside))
        .withColumn("__changed", found)
        .withColumns(
            {
                "first_edge": edge, "last_edge": edge, "changes": F.col("__changed").cast("long"),
                "first_change": at, "last_change": at,
            }
        )
    )
    if bucket == "minute":
        return _folded(single, keys)
    minutes = _folded(single, [*keys, "minute"])
    return _folded(_carried(minutes, Window.partitionBy(*keys).orderBy("minute"), country_gap), keys)


def anomaly_partials(
    events: DataFrame, *by: str, bucket: str = "minute", country_gap: str | None = None
) -> DataFrame:
    """Mergeable rows per (``by``, user, bucket): event counts, edge summaries, and one row per address."""
    keys = [*by, "user_id", "bucket"]
    counts = events_per_bucket(events, bucket, by)
    edges = edge_summaries(events, bucket, country_gap, by)
    addresses = _seen(events, bucket, by).filter(F.col("signed") > 0).select(*keys, "ip_address").distinct()
    parts = [counts, edges, addresses]
    named = [p.withColumn("is_address", F.lit(p is addresses)) for p in parts]
    return named[0].unionByName(named[1], allowMissingColumns=True).unionByName(named[2], allowMissingColumns=True)


def _addresses(partials: DataFrame) -> DataFrame:
    return partials.filter("is_address").select("user_id", "bucket", "ip_address")


def fold_signals(partials: DataFrame, country_gap: str | None = None) -> DataFrame:
    """One row per (user, bucket) with everything the flags depend on, from :func:`anomaly_partials` of any days.

    The parts are stacked and shuffled once by user; that shuffle serves the
    merge per bucket, the comparison of neighbouring buckets and the running sum
    of new addresses. A user has at most three rows per bucket there, however
    many events it has.
    """
    fresh = new_values(_addresses(partials), ["user_id"], "bucket", "ip_address")
    summaries = partials.filter(~F.col("is_address")).drop("ip_address", "is_address")
    parts = summaries.unionByName(fresh, allowMissingColumns=True)
    values = [
        "number_of_events", "first_ts", "last_ts", "first_edge", "last_edge", "n_events", "changes", "first_change",
        "last_change", "new_values",
    ]
    along = Window.partitionBy("user_id").orderBy("bucket")
    merged = (
        parts.repartition("user_id")
        .groupBy("user_id", "bucket")
        .agg(*[F.max(c).alias(c) for c in values])
        .withColumn(
            "running_addresses",
            F.coalesce(F.sum("new_values").over(along.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)),
        )
    )
    return _carried(merged, along, country_gap).select(
        "user_id",
        "bucket",
        "number_of_events",
        "first_ts",
        "last_ts",
        F.col("changes").alias("suspicious_events"),
        (F.col("n_events") - F.col("changes")).alias("other_events"),
        F.col("first_change").alias("first_suspicious"),
        F.col("last_change").alias("last_suspicious"),
        "running_addresses",
    )


def bucket_signals(events: DataFrame, bucket: str = "minute", country_gap: str | None = None) -> DataFrame:
    """The signals of the flags per (user, bucket)."""
    return fold_signals(anomaly_partials(events, bucket=bucket, country_gap=country_gap), country_gap)


def _case_columns(spike: Column, suspicious: Column, bot: Column) -> dict[str, Column]:
    """Code, type, reason and severity of a combination of signs."""
    signs = {"spike": spike, "suspicious": suspicious, "bot": bot}
    slot = spike.cast("int") + 2 * suspicious.cast("int") + 4 * bot.cast("int")
    code = F.element_at(F.array(*[F.lit(c) for c in CASE_CODES]), slot + 1)

    def joined(separator: str, texts: dict[str, str]) -> Column:
        parts = [F.when(sign, F.lit(texts[name])) for name, sign in signs.items()]
        return F.when(spike | suspicious | bot, F.concat_ws(separator, *parts)).otherwise(NO_FLAG)

    return {
        "case_severity": code,
        "flag_type": joined("_", FLAG_NAMES),
        "flag_reason": joined(";", FLAG_REASONS),
        "severity": F.element_at(F.array(*[F.lit(s) for s in SEVERITIES]), code + 1),
    }


def _cases(signals: DataFrame, spike_gt: int, ip_gt: int) -> DataFrame:
    spike = F.col("number_of_events") > spike_gt
    bot = F.col("running_addresses") > ip_gt
    whole = spike | bot
    kinds = F.array(
        F.when(F.col("suspicious_events") > 0, F.lit(True)),
        F.when(whole & (F.col("other_events") > 0), F.lit(False)),
    )
    flagged = (
        signals.filter(whole | (F.col("suspicious_events") > 0))
        .withColumn("suspicious", F.explode(F.array_compact(kinds)))
        .withColumns({"spike": spike, "bot": bot})
    )
    return flagged.withColumns(
        {
            **_case_columns(F.col("spike"), F.col("suspicious"), F.col("bot")),
            "first_seen": F.date_format(F.when(whole, F.col("first_ts")).otherwise(F.col("first_suspicious")), SECOND_FORMAT),
            "last_seen": F.date_format(F.when(whole, F.col("last_ts")).otherwise(F.col("last_suspicious")), SECOND_FORMAT),
        }
    )


def anomaly_cases(
    events: DataFrame, bucket: str = "minute", spike_gt: int = 40, ip_gt: int = 3, country_gap: str | None = None
) -> DataFrame:
    """Flagged (user, bucket) pairs: up to two cases each, with and without a change of country."""
    return _cases(bucket_signals(events, bucket, country_gap), spike_gt, ip_gt)


def fold_flags(
    partials: DataFrame,
    bucket: str = "minute",
    spike_gt: int = 40,
    ip_gt: int = 3,
    country_gap: str | None = None,
    explode_outer: bool = False,
    now: Column | None = None,
) -> DataFrame:
    """The mart from :func:`anomaly_partials` of any days, made with the same bucket and gap."""
    cases = _cases(fold_signals(partials, country_gap), spike_gt, ip_gt)
    joined = null_safe_join(cases, _addresses(partials), ["user_id", "bucket"], "left" if explode_outer else "inner")
    return joined.select(
        "ip_address",
        "user_id",
        F.date_format("bucket", BUCKET_FORMATS[bucket]).alias("event_timestamp"),
        "case_severity",
        "flag_type",
        "flag_reason",
        "number_of_events",
        "first_seen",
        "last_seen",
        "severity",
        F.date_format(F.current_timestamp() if now is None else now, SECOND_FORMAT).alias("detection_timestamp"),
    )


def anomaly_flags(
    events: DataFrame,
    bucket: str = "minute",
    spike_gt: int = 40,
    ip_gt: int = 3,
    country_gap: str | None = None,
    explode_outer: bool = False,
    now: Column | None = None,
) -> DataFrame:
    """One row per flagged case and address seen in its bucket.

    Cases whose bucket has no address are left out unless ``explode_outer``.
    """
    partials = anomaly_partials(events, bucket=bucket, country_gap=country_gap)
    return fold_flags(partials, bucket, spike_gt, ip_gt, country_gap, explode_outer, now)

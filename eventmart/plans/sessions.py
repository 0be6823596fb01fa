"""Session summary per user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def session_durations(events: DataFrame) -> DataFrame:
    """Seconds between the first and last event of each (user, session)."""
    return events.groupBy("user_id", "session_id").agg(
        (F.unix_timestamp(F.max("timestamp")) - F.unix_timestamp(F.min("timestamp"))).alias("session_duration")
    )


def most_used_platform(events: DataFrame) -> DataFrame:
    """The platform with most events in named sessions; ties go to the first name."""
    return (
        events.groupBy("user_id", "platform")
        .agg(F.count("session_id").alias("n"))
        .groupBy("user_id")
        .agg(F.min(F.struct(-F.col("n"), F.col("platform").isNull(), "platform"))["platform"].alias("most_used_platform"))
    )


def session_partials(events: DataFrame, *by: str) -> DataFrame:
    """Mergeable rows per (``by``, user, session, platform): events in a named session, first and last time."""
    return (
        events.filter(F.col("user_id").isNotNull())
        .groupBy(*by, "user_id", "session_id", "platform")
        .agg(
            F.count("session_id").alias("n"),
            F.min("timestamp").alias("first_ts"),
            F.max("timestamp").alias("last_ts"),
        )
    )


def fold_sessions(partials: DataFrame) -> DataFrame:
    """The summary per user from :func:`session_partials` of any days; a session may go over several.

    Both groupings, (user, session) and (user, platform), are made of the
    partial rows. Their rows are folded per user after a second partial
    aggregation, so a hot user reaches the final task as one row per upstream
    task.
    """
    grain = (
        partials.groupingSets(
            [[F.col("user_id"), F.col("session_id")], [F.col("user_id"), F.col("platform")]],
            "user_id",
            "session_id",
            "platform",
        )
        .agg(
            F.grouping("platform").alias("by_session"),
            F.sum("n").alias("n"),
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
        )
    )
    session = F.col("by_session") == 1
    length = F.unix_timestamp("last_ts") - F.unix_timestamp("first_ts")
    rank = F.struct(-F.col("n"), F.col("platform").isNull(), "platform")
    per_user = grain.groupBy("user_id").agg(
        F.sum(F.when(session, length)).alias("total_length"),
        F.count(F.when(session, F.col("session_id"))).alias("total_session_per_user"),
        F.min(F.when(~session, rank))["platform"].alias("most_used_platform"),
        F.max("last_ts").alias("last_seen_timestamp_in_IST"),
        F.sum(F.when(session, F.col("n"))).alias("total_events_per_user"),
    )
    mean = F.try_divide("total_length", "total_session_per_user").cast("decimal(10,2)")
    return per_user.select(
        "user_id",
        "total_session_per_user",
        F.round(mean, 2).alias("avg_session_duration_in_seconds"),
        "most_used_platform",
        "last_seen_timestamp_in_IST",
        "total_events_per_user",
    )


def user_session_summary(events: DataFrame) -> DataFrame:
    """Sessions, mean session length, favourite platform, last event and event count per user, in one scan."""
    return fold_sessions(session_partials(events))

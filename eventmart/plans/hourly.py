"""Active users and sessions per hour, platform and country."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["date", "hour", "platform", "country"]


def hourly_active_users(events: DataFrame) -> DataFrame:
    """Distinct users, events and distinct sessions per local date and hour.

    Groups on the date and the hour number; the text form is made once per
    group. ``new_sessions`` counts the sessions active in the bucket. Events of
    one session are one row before the distinct counts multiply rows.
    """
    hours = [F.to_date("timestamp").alias("day"), F.hour("timestamp").alias("h"), "platform", "country"]
    return (
        events.groupBy(*hours, "user_id", "session_id")
        .agg(F.count("event_id").alias("n"))
        .groupBy("day", "h", "platform", "country")
        .agg(
            F.count_distinct("user_id").alias("unique_users"),
            F.sum("n").alias("total_events"),
            F.count_distinct("session_id").alias("new_sessions"),
        )
        .select(
            F.date_format("day", "yyyy-MM-dd").alias("date"),
            F.lpad(F.col("h").cast("string"), 2, "0").alias("hour"),
            "platform",
            "country",
            "unique_users",
            "total_events",
            "new_sessions",
        )
    )

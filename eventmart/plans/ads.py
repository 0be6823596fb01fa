"""Clicks, impressions and spend of ads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


COUNTS = ["ad_clicks_count", "ad_impressions_count"]


def ad_partials(events: DataFrame, *by: str) -> DataFrame:
    """Mergeable counts per (``by``, ad): clicks and impressions. An ad with other events only has zeros."""
    kind = F.col("event_type")
    return (
        events.filter(F.col("ad_id").isNotNull())
        .groupBy(*by, "ad_id")
        .agg(F.count_if(kind == "ad_click").alias(COUNTS[0]), F.count_if(kind == "ad_impression").alias(COUNTS[1]))
    )


def _with_rate(counts: DataFrame) -> DataFrame:
    return counts.withColumn("ctr", F.round(F.try_divide(*COUNTS), 2))


def ad_event_counts(events: DataFrame) -> DataFrame:
    """Clicks, impressions and click-through rate per ad; the rate is null without impressions."""
    return _with_rate(ad_partials(events))


def _with_spend(counts: DataFrame, ads: DataFrame) -> DataFrame:
    used = F.coalesce(F.try_divide("spend_usd", "budget_usd") * 100, F.lit(0.0))
    spend = ads.filter(F.col("ad_id").isNotNull()).select(
        "ad_id", "campaign_id", F.round(used, 2).alias("spend_percentage")
    )
    return counts.join(spend, "ad_id").select("ad_id", "campaign_id", *COUNTS, "ctr", "spend_percentage")


def ad_performance(events: DataFrame, ads: DataFrame) -> DataFrame:
    """Event counts joined with each ad's campaign and budget use.

    ``ads`` holds one row per ad: the current rows of its history.
    """
    return _with_spend(ad_event_counts(events), ads)


def fold_ads(partials: DataFrame, ads: DataFrame) -> DataFrame:
    """The mart from :func:`ad_partials` of any days."""
    return _with_spend(_with_rate(partials.groupBy("ad_id").agg(*[F.sum(c).alias(c) for c in COUNTS])), ads)
